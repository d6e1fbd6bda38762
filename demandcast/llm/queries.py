"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.llm import (
    conversations,
    exact_dedup,
    fingerprints,
    language_model,
    licenses,
    mixing,
    packing,
    quality,
    sharding,
    shingle_join,
    simhash,
    token_files,
    vector_codes,
)
from demandcast.llm.common import read_table
from demandcast.sources.storage import Storage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_exact_dedup(spark, sf_dir):
    """Equal texts by block naming; the row with the largest doc_id stays."""
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), Storage(spark))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op2_licenses(spark, sf_dir):
    """License notices of every document, with what differs from the notice's wording."""
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"), Storage(spark))
    return found.select(
        "doc_id",
        "at",
        "license",
        F.round("saved", 6).alias("saved"),
        "covered",
        F.array_join("missing", " ").alias("missing"),
        F.array_join("between", " ").alias("between"),
    )


@query
def op3_fingerprints(spark, sf_dir):
    """256 bins of 4 bits over five-word shingles, for each text and its edited form."""
    rows = fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        fingerprints.as_hex(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op4_sharding(spark, sf_dir):
    """Place every document on one of 64 shards."""
    shards = [f"shard-{n:03d}" for n in range(sharding.SHARDS)]
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, shards).select("doc_id", "slot", "shard")


@query
def op5_token_files(spark, sf_dir):
    """Ids of the 50k byte-level vocabulary, written in id order and read back."""
    store = Storage(spark)
    written = token_files.write_token_files(
        read_table(spark, sf_dir, "documents"), f"{store.folder}/tokens", "byte_bpe_50k.json"
    )
    read = token_files.read_token_files(store.table("files", written))
    return read.select(
        "doc_id",
        "start",
        F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query
def op6_language_model(spark, sf_dir):
    """Lattice likelihood over the 32k piece vocabulary, learned outside the held-out fold."""
    return language_model.score_documents(read_table(spark, sf_dir, "documents"), Storage(spark))


@query
def op7_mixing(spark, sf_dir):
    """Sources weigh 3, 1, 2 in turn and share 150 % of all words."""
    docs = read_table(spark, sf_dir, "documents")
    taken = mixing.take_shares(docs, mixing.repeating_weights(docs, [3, 1, 2]), Storage(spark), 1.5)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_simhash(spark, sf_dir):
    """64 bits over three-word shingles, linked at two bits or fewer."""
    groups = simhash.near_groups(read_table(spark, sf_dir, "documents"), Storage(spark))
    return groups.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query
def op9_packing(spark, sf_dir):
    """Pieces of at most 2048 ids of the 49k word-level vocabulary, in as few sequences as it can."""
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), Storage(spark))
    return packed.drop("ids")


@query
def op10_quality(spark, sf_dir):
    """Score every document with an additive model fitted outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


@query
def op11_conversations(spark, sf_dir):
    """Conversations that are spoilt by a hash of their turns, then repaired at the least cost."""
    turns = read_table(spark, sf_dir, "conversations")
    return conversations.conversation_digests(
        conversations.repair_conversations(conversations.damage(turns), Storage(spark), original=turns)
    )


@query
def op12_shingle_join(spark, sf_dir):
    """Texts whose sets of five-word shingles have a similarity of 0.8 or more."""
    return shingle_join.jaccard_groups(read_table(spark, sf_dir, "documents"), Storage(spark))


@query
def op13_vector_codes(spark, sf_dir):
    """Sixteen parts a vector, 64 entries a codebook, two rounds."""
    coded, books = vector_codes.compress_vectors(read_table(spark, sf_dir, "embeddings"), Storage(spark))
    digest = F.lit(vector_codes.codebook_digest(books))
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
