"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts over the whole text. Each feature is cut into bins by quantiles. Shallow trees
are boosted in cycles, one feature at a time and each on that feature's bins alone, so what they
learn adds up to a lookup table per feature. Then the pairs of features that explain most of what
is left get tables of their own, boosted the same way. A score is the sum of table entries, put
through the logistic function: a few vectorised additions per document.

The model is fitted on at most ``MAX_ROWS`` labelled rows, chosen by a hash of their ids; scoring
covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import fold, fresh_name, whole_text, with_row_id

#: Most labelled rows that a fit uses; their features are gathered on the driver (200 bytes a row).
MAX_ROWS = 40_000
THRESHOLD = 0.3
HELD_OUT_FOLD = 0

CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "other")
FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_length", "line_length",
    "upper", "digit", "stop", "mark", "symbol", "other",
    "distinct_words", "distinct_lines", "longest_word", "short_words", "upper_words", "lone_symbols", "top_word", "title_words",
)


def _byte_classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    for name, members in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("space", b" \t\r\x0b\x0c"),
        ("newline", b"\n"),
        ("stop", b".,;:"),
        ("mark", b"!?\"'()-"),
        ("symbol", b"#$%&*+/<=>@[\\]^_`{|}~"),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


BYTE_CLASS = _byte_classes()


def features_of(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per whole text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    at = {name: n for n, name in enumerate(FEATURES)}
    for row, text in enumerate(texts):
        body = text.encode("utf-8")
        size = len(body)
        if not size:
            continue
        counts = np.bincount(BYTE_CLASS[np.frombuffer(body, dtype=np.uint8)], minlength=len(CLASSES))
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        x = out[row]
        x[at["log_bytes"]], x[at["log_words"]], x[at["log_lines"]] = np.log1p([size, len(words), len(lines)])
        letters = max(1, int(counts[0] + counts[1]))
        x[at["upper"]] = counts[1] / letters
        for name in ("digit", "stop", "mark", "symbol", "other"):
            x[at[name]] = counts[CLASSES.index(name)] / size
        if not words:
            continue
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        seen: dict[str, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        n = len(words)
        x[at["word_length"]] = lengths.mean()
        x[at["longest_word"]] = np.log1p(lengths.max())
        x[at["short_words"]] = (lengths <= 2).mean()
        x[at["line_length"]] = np.log1p(size / max(1, len(lines)))
        x[at["distinct_words"]] = len(seen) / n
        x[at["distinct_lines"]] = len(set(lines)) / max(1, len(lines))
        x[at["top_word"]] = max(seen.values()) / n
        x[at["upper_words"]] = sum(k for w, k in seen.items() if w.isupper()) / n
        x[at["title_words"]] = sum(k for w, k in seen.items() if w.istitle()) / n
        x[at["lone_symbols"]] = sum(k for w, k in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?") / n
    return out


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features, over bins limited by ``edges``."""

    edges: list[np.ndarray]
    intercept: float
    main: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def logit(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        total = np.full(len(x), self.intercept)
        for table, b in zip(self.main, bins):
            total += table[b]
        for (f, g), table in self.pairs.items():
            total += table[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.logit(x)))


def _best_cut(grad: np.ndarray, hess: np.ndarray, penalty: float, low: int, high: int) -> tuple[float, int]:
    """Largest gain of cutting bins [low, high) in two, and the place of the cut."""
    if high - low < 2:
        return 0.0, low
    g, h = np.cumsum(grad[low:high]), np.cumsum(hess[low:high])
    left, right = g[:-1] ** 2 / (h[:-1] + penalty), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + penalty)
    gain = left + right - g[-1] ** 2 / (h[-1] + penalty)
    at = int(np.argmax(gain))
    return float(gain[at]), low + at + 1


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, penalty: float) -> np.ndarray:
    """Steps of a tree with at most three leaves over the bins of one feature."""
    cuts = [0, len(grad)]
    for _ in range(2):
        found = [_best_cut(grad, hess, penalty, a, b) for a, b in zip(cuts, cuts[1:])]
        gain, cut = max(found)
        if gain <= 1e-9:
            break
        cuts = sorted([*cuts, cut])
    step = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        step[a:b] = grad[a:b].sum() / (hess[a:b].sum() + penalty)
    return step


def _four_leaves(grad: np.ndarray, hess: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts the first feature, then the second on either side."""
    best = (-1.0, np.zeros_like(grad))
    for at in range(1, len(grad)):
        gain, step = 0.0, np.zeros_like(grad)
        for a, b in ((0, at), (at, len(grad))):
            g, h = grad[a:b].sum(axis=0), hess[a:b].sum(axis=0)
            more, cut = _best_cut(g, h, penalty, 0, len(g))
            for c, d in ((0, cut), (cut, len(g))):
                if d > c:
                    total, weight = g[c:d].sum(), h[c:d].sum() + penalty
                    step[a:b, c:d] = total / weight
                    gain += total**2 / weight
        if gain > best[0]:
            best = (gain, step)
    return best


def fit_additive(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 32,
    coarse_bins: int = 6,
    cycles: int = 60,
    pair_count: int = 8,
    pair_cycles: int = 25,
    rate: float = 0.15,
    penalty: float = 2.0,
) -> AdditiveModel:
    """Fit by cyclic boosting of the logistic loss. Without rows, or with one class, the score is constant."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) if n else np.zeros(0) for f in range(width)]
    share = (y.sum() + 0.5) / (n + 1.0)
    model = AdditiveModel(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges])
    model.coarse = [np.minimum(np.arange(len(e) + 1) * coarse_bins // (len(e) + 1), coarse_bins - 1) for e in edges]
    if n == 0 or y.min() == y.max():
        return model
    held = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    total = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for f in range(width):
            if not len(edges[f]):
                continue
            g, h = slopes()
            size = len(edges[f]) + 1
            step = rate * _shallow_tree(np.bincount(held[f], g, size), np.bincount(held[f], h, size), penalty)
            model.main[f] += step
            total += step[held[f]]

    rough = [model.coarse[f][held[f]] for f in range(width)]

    def cells(f: int, g: int, value: np.ndarray) -> np.ndarray:
        return np.bincount(rough[f] * coarse_bins + rough[g], value, coarse_bins**2).reshape(coarse_bins, coarse_bins)

    grad, hess = slopes()
    gains = [
        (_four_leaves(cells(f, g, grad), cells(f, g, hess), penalty)[0], f, g)
        for f in range(width)
        for g in range(f + 1, width)
        if len(edges[f]) and len(edges[g])
    ]
    chosen = [(f, g) for _, f, g in sorted(gains, reverse=True)[:pair_count]]
    model.pairs = {pair: np.zeros((coarse_bins, coarse_bins)) for pair in chosen}
    for _ in range(pair_cycles):
        for f, g in chosen:
            grad, hess = slopes()
            step = rate * _four_leaves(cells(f, g, grad), cells(f, g, hess), penalty)[1]
            model.pairs[f, g] += step
            total += step[rough[f], rough[g]]
    return model


def _featured(rows: DataFrame, columns: str) -> DataFrame:
    """``rows`` (their last column is the text) with the text replaced by its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features_of(batch.column(batch.num_columns - 1).to_pylist())
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(FEATURES)), pa.array(found.reshape(-1))
            )
            names = [*batch.schema.names[:-1], "features"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], flat], names=names)

    return rows.mapInArrow(run, f"{columns}, features array<double>")


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Fit on the labelled rows of ``docs`` outside the held-out fold.

    Rows without a label of 0 or 1 are left out, as are ids with labels of both kinds. Of more
    than ``max_rows`` the ones with the smallest hash of the id are used. ``doc_id``, lang and
    source only choose rows; the model sees the text alone.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & (fold() != HELD_OUT_FOLD))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    sample = _featured(rows, "doc_id long, quality int")
    # ids may repeat in docs: the bound holds for rows as well
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("quality", "features").toPandas()
    x = np.stack(sample["features"].to_numpy()) if len(sample) else np.zeros((0, len(FEATURES)))
    order = np.lexsort([*x.T, sample["quality"].to_numpy()])
    return fit_additive(x[order], sample["quality"].to_numpy(dtype=float)[order])


def score_quality(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, held_out, score, predicted) for every row; a null text counts as empty.

    An empty table gives no rows; columns of ``docs`` other than doc_id and text are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = held.value.score(features_of(batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], schema=schema)

    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), "row")
    scored = rows.select("row", "doc_id", (fold() == HELD_OUT_FOLD).alias("held_out"), "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns; nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    text, score = fresh_name(docs, "whole_text"), fresh_name(docs, "score")

    @F.pandas_udf("double")
    def score_of(texts):
        import pandas as pd

        return pd.Series(held.value.score(features_of(texts.tolist())))

    scored = docs.withColumn(text, whole_text()).withColumn(score, score_of(F.col(text)))
    return scored.where(F.col(score) >= threshold).select(*docs.columns)
