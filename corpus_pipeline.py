"""The corpus pipeline: quality, exact and near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``docs`` is a stored table, the
result of the stage before. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandcast.llm import exact_dedup, mixing, packing, quality, simhash
from demandcast.llm.common import read_table
from demandcast.sources.storage import Storage

#: Sources in code point order weigh so in turn; together they take all words once.
SOURCE_WEIGHTS = [3, 1, 2]
SOURCE_SHARE = 1.5
#: The workers also hold what earlier stages left, so the encoder remembers less than on its own.
KEPT_CHUNKS = 300_000


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it is fitted on the labelled rows of ``docs``."""
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.drop_low_quality(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs, Storage(spark))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id: 64 bits over three-word shingles within two bits."""
    return simhash.drop_near_duplicates(docs, Storage(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their shares; a document that is taken twice is there twice."""
    weights = mixing.repeating_weights(docs, SOURCE_WEIGHTS)
    return mixing.mix_sources(docs, weights, Storage(spark), SOURCE_SHARE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their ids, sequence and place."""
    return packing.pack_documents(docs, Storage(spark), keep=KEPT_CHUNKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("exact_dedup", drop_exact),
    ("simhash_near_dedup", drop_near),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

#: Trees, 64-bit hashes of shingles and tokenizers are beyond SQL; tests check run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    store = Storage(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.table(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
