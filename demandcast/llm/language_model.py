"""Language-model scores of documents by subword lattice likelihood.

A document belongs to one of a few hidden classes: the languages of the training documents. In a
class, a word's probability sums over all ways to build it: from the pieces of an existing
vocabulary in any segmentation, or, if training documents of the class hold it, as one piece of
its own with absolute discounting:

    P(word | class) = max(c - D, 0) / N + D * V / N * L(word)

with c its count, N all tokens, V distinct tokens of the class, D = n1 / (n1 + 2 n2) from the
tokens that occur once and twice, and L the marginal probability over the class's lattice of
pieces. The pieces' starting weights are the vocabulary's; they are fitted to the distinct
training words of each class by expectation maximisation. A document is its words and one end; its
probability is summed over the classes, whose weights are their shares of training documents. The
language column chooses what is learned from and is not used to score.

Documents are read in chunks of a bounded size. Each distinct word of a chunk is looked up once by
a shuffle, so what moves is chunks' vocabularies, and no table is sent to every task but the
vocabulary's own piece weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import fold, lower_words, own_store, whole_text, with_row_id
from demandcast.llm.lattice import Lattice, read_vocabulary
from demandcast.llm.tokens import tokenizer_path
from demandcast.sources.storage import Storage

VOCABULARY = "piece_bpe_32k.model"
CHUNK_BYTES = 24 << 20
WORDS_AT_ONCE = 50_000
ROUNDS = 3
HELD_OUT_FOLD = 1
#: Most classes; documents in rarer languages share the last.
CLASSES = 8
#: Probability of the end if nothing was learned, and what each piece gets besides its expected uses.
END_SHARE, LEAST_USE = 1e-3, 1e-2
DISCOUNT = 0.75


def _chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut so that each has rows of one chunk, with the chunk's number; the same each time a table is read."""
    chunk, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(text).buffers()[1], dtype=np.int32)[batch.column(text).offset :][: len(batch) + 1])
        first = 0
        for n, size in enumerate(sizes.tolist()):
            if held and held + size > CHUNK_BYTES:
                if n > first:
                    yield chunk, batch.slice(first, n - first)
                chunk, held, first = chunk + 1, 0, n
            held += size
        yield chunk, batch.slice(first)


def _chunk_words(rows: DataFrame, classes: int) -> DataFrame:
    """Distinct words of each chunk, numbered as they come: chunk, at, word, u0, u1, ... (uses by class)."""
    names = ["chunk", "at", "word", *(f"u{k}" for k in range(classes))]

    def emit(chunk: int, index: dict[bytes, int], uses: np.ndarray) -> Iterator[pa.RecordBatch]:
        words = list(index)
        for low in range(0, len(words), WORDS_AT_ONCE):
            some = words[low : low + WORDS_AT_ONCE]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), chunk, dtype=np.int64)),
                    pa.array(np.arange(low, low + len(some), dtype=np.int32)),
                    pa.array(some, pa.binary()),
                    *(pa.array(u[low : low + len(some)]) for u in uses),
                ],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, index, uses = None, {}, np.zeros((classes, 1 << 16), dtype=np.int64)
        for chunk, batch in _chunks(batches, 2):
            if chunk != now:
                yield from emit(now, index, uses)
                now, index, uses = chunk, {}, np.zeros((classes, 1 << 16), dtype=np.int64)
            for k, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.array([index.setdefault(w, len(index)) for w in lower_words(text)], dtype=np.int64)
                if len(index) > uses.shape[1]:
                    more = np.zeros((classes, max(uses.shape[1], len(index))), dtype=np.int64)
                    uses = np.concatenate([uses, more], axis=1)
                if k is not None:
                    np.add.at(uses[k], ids, 1)
        yield from emit(now, index, uses)

    schema = "chunk long, at int, word binary, " + ", ".join(f"u{k} long" for k in range(classes))
    return rows.select("row", "class", "text").mapInArrow(run, schema)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _words(batch: pa.RecordBatch, column: int) -> list[str]:
    return [w.decode("utf-8") for w in batch.column(column).to_pylist()]


def fit_pieces(words: DataFrame, classes: int, path: str, rounds: int = ROUNDS) -> Lattice:
    """Piece probabilities by class, fitted to the distinct ``words`` (word, u0, u1, ...) it uses, each counted once.

    The driver holds one number per class and piece. A class without words keeps the vocabulary's own weights.
    """
    spark = words.sparkSession
    pieces, start = read_vocabulary(path)
    weights = np.tile(start, (classes, 1))
    names = [f"u{k}" for k in range(classes)]
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(Lattice(pieces, np.log(weights)))

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((classes, len(pieces)))
            lattices = [held.value.of_class(k) for k in range(classes)]
            waiting: list[list[str]] = [[] for _ in range(classes)]  # long runs of words make long vectors
            for batch in batches:
                for k, some in enumerate(waiting):
                    some += _words(batch.filter(pa.compute.greater(batch.column(1 + k), 0)), 0)
                    if len(some) >= WORDS_AT_ONCE:
                        lattices[k].run(some, counts[k])
                        some.clear()
            for k, some in enumerate(waiting):
                lattices[k].run(some, counts[k])
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.reshape(-1)[at])], names=["piece", "uses"])

        found = words.select("word", *names).mapInArrow(expect, "piece long, uses double")
        rows = found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        held.destroy()
        counts = np.zeros(weights.size)
        counts[[r["piece"] for r in rows]] = [r["uses"] for r in rows]
        counts = counts.reshape(weights.shape)
        fitted = (counts + LEAST_USE) / (counts + LEAST_USE).sum(axis=1, keepdims=True)
        weights = np.where(counts.sum(axis=1, keepdims=True) > 0, fitted, weights)
    return Lattice(pieces, np.log(weights))


@dataclass
class Totals:
    """What the classes hold, an entry per class: documents, tokens, distinct tokens, discount."""

    ends: np.ndarray
    tokens: np.ndarray
    distinct: np.ndarray
    discount: np.ndarray

    @staticmethod
    def of(words: DataFrame, ends: list[int]) -> Totals:
        n = range(len(ends))
        sums = [F.sum(f"u{k}").alias(f"s{k}") for k in n]
        kinds = [F.count_if(F.col(f"u{k}") == x).alias(f"n{x}_{k}") for k in n for x in (1, 2)]
        found = words.agg(*sums, *kinds, *[F.count_if(F.col(f"u{k}") > 0).alias(f"v{k}") for k in n]).first()
        once = np.array([found[f"n1_{k}"] for k in n], dtype=float)
        twice = np.array([found[f"n2_{k}"] for k in n], dtype=float)
        discount = np.where((once > 0) & (twice > 0), once / np.maximum(once + 2 * twice, 1), DISCOUNT)
        return Totals(
            np.array(ends, dtype=float),
            np.array([found[f"s{k}"] or 0 for k in n], dtype=float) + ends,
            np.array([found[f"v{k}"] for k in n], dtype=float) + [e > 0 for e in ends],
            discount,
        )

    def log10(self, uses: np.ndarray, unknown: np.ndarray) -> np.ndarray:
        """log10 probabilities by class of tokens with these uses and natural log lattice probabilities."""
        with np.errstate(divide="ignore"):
            seen = np.log(np.maximum(uses - self.discount[:, None], 0.0))
            rest = np.log(self.discount * self.distinct)[:, None] + unknown
        return (np.logaddexp(seen, rest) - np.log(self.tokens)[:, None]) / math.log(10)


def score_documents(docs: DataFrame, store: Storage, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Scores of every row, learned from the rows outside the held-out fold.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null texts count
    as empty; an empty text is one end. Null ids are in the fold of the empty text. An empty table
    gives no rows; without training documents the end alone is scored by its share of unknowns.
    """
    store = own_store(store)
    path = path or tokenizer_path(VOCABULARY)
    language = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    training = fold() != HELD_OUT_FOLD
    shares = (
        docs.where(training).groupBy(language.alias("lang")).count().orderBy(F.desc("count"), "lang").limit(CLASSES).collect()
    )
    named = [r["lang"] for r in shares]
    classes = max(1, len(named))
    place = F.array_position(F.array(*[F.lit(x) for x in named]).cast("array<string>"), language) - 1
    of_class = F.when(place < 0, F.lit(classes - 1)).otherwise(place).cast("int")
    rows = with_row_id(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.when(training, of_class).alias("class"), whole_text().alias("text")
        ),
        "row",
    )
    counted = {r["class"]: r["count"] for r in rows.where("class is not null").groupBy("class").count().collect()}
    ends = [counted.get(k, 0) for k in range(classes)]
    chunk_words = store.table("chunk_words", _chunk_words(rows, classes))
    names = [f"u{k}" for k in range(classes)]
    words = store.table("words", chunk_words.groupBy("word").agg(*[F.sum(u).alias(u) for u in names]))
    known_class = Totals.of(words, ends)
    uses_of = sum((F.col(u) for u in names[1:]), F.col(names[0]))
    tokens = int(known_class.tokens.sum())
    distinct = words.where(uses_of > 0).count() + (1 if sum(ends) else 0)
    lattice = docs.sparkSession.sparkContext.broadcast(fit_pieces(words, classes, path, rounds))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(batches, WORDS_AT_ONCE):
            uses = np.stack([some.column(1 + k).to_numpy() for k in range(classes)])
            unknown = lattice.value.run(_words(some, 0))
            weight = known_class.log10(uses, unknown) if tokens else (unknown + math.log1p(-END_SHARE)) / math.log(10)
            held = [pa.array(w.astype(np.float32)) for w in weight]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(uses.sum(axis=0)), *held], names=["word", "uses", *weights]
            )

    weights = [f"w{k}" for k in range(classes)]
    weighed = store.table(
        "weighed", words.mapInArrow(weigh, "word binary, uses long, " + ", ".join(f"{w} float" for w in weights))
    )
    known = chunk_words.select("chunk", "at", "word").join(weighed, "word").select("chunk", "at", "uses", *weights)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, batch in _chunks(batches, 3):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(batch), chunk, dtype=np.int64)), *batch.columns],
                names=["chunk", "row", "doc_id", "held_out", "text"],
            )

    tagged = rows.select("row", "doc_id", F.col("class").isNull().alias("held_out"), "text").mapInArrow(
        tag, "chunk long, row long, doc_id long, held_out boolean, text string"
    )
    base_divisor = tokens + 0.5 * (distinct + 1)
    end_base = math.log10((sum(ends) + 0.5) / base_divisor)
    if tokens:
        end_score = known_class.log10(known_class.ends[:, None], np.full((classes, 1), -np.inf))[:, 0]
        share = np.log10(np.array(ends) / sum(ends))
    else:
        end_score, share = np.full(classes, math.log10(END_SHARE)), np.zeros(classes)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def total(texts: pa.Table, looked_up: pa.Table) -> pa.Table:
        at = looked_up.column("at").to_numpy()
        uses, weight = np.zeros(len(at)), np.zeros((classes, len(at)))
        uses[at] = looked_up.column("uses").to_numpy()
        for k, name in enumerate(weights):
            weight[k, at] = looked_up.column(name).to_numpy()
        base = np.log10((uses + 0.5) / base_divisor)
        index: dict[bytes, int] = {}
        out = []
        texts = texts.sort_by("row")
        columns = (texts.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))
        for doc_id, held_out, text in zip(*columns):
            found = np.array([index.setdefault(w, len(index)) for w in lower_words(text)], dtype=np.int64)
            by_class = weight[:, found].sum(axis=1) + end_score + share
            score = float(np.logaddexp.reduce(by_class * math.log(10))) / math.log(10)
            n_known = int((uses[found] > 0).sum()) + (1 if sum(ends) else 0)
            out.append((doc_id, held_out, len(found) + 1, n_known, tokens, float(base[found].sum()) + end_base, score))
        if not out:
            return schema.empty_table()
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return tagged.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        total,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
