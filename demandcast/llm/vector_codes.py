"""Compression of vectors to one code per part, by codebooks that are fitted to all vectors.

A vector's components become integers and the vector is cut into equal parts. Each part position has
a codebook. To find a part's nearest entry, the grid cell that the part lies in is looked up: the
first time a cell is met, the smallest and the largest distance of its box to every entry are
computed, and entries whose smallest distance exceeds the least of the largest ones are dropped, for
they are farther than some other entry from every place in the box. A cell's remaining entries are
remembered and only they are compared exactly. A round's sums per entry are added up in each task
before they leave it, so a round moves one row per entry and task, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from demandcast.llm.common import own_store
from demandcast.operators.joins import lookup_join
from demandcast.sources.storage import Storage

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Edge of a grid cell, in the integer units of the components. It changes speed only.
CELL = 32
#: Cells that a task remembers; beyond it starts anew.
KEEP_CELLS = 200_000
VECTORS_AT_ONCE = 4096
#: Integer components stay below this, so that squared distances fit in 64 bits.
LARGEST = 1 << 26


def integer_components(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors are kept, and the floors of their scaled components as little-endian 32-bit integers.

    A vector is dropped if it is null or holds a null or non-finite component. A component beyond the range that
    squared distances allow raises.
    """
    keep, found = np.zeros(len(vectors), dtype=bool), []
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    whole = np.isfinite(values)
    with np.errstate(over="ignore"):
        scaled = np.floor(np.where(whole, values, 0.0) * scale)
    absent = vectors.is_null().to_numpy(zero_copy_only=False)
    bad_before = np.concatenate([[0], np.cumsum(~whole)])
    for n, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        if absent[n] or bad_before[end] > bad_before[end - size]:
            continue
        own = scaled[end - size : end]
        if size and np.abs(own).max() >= LARGEST:
            raise ValueError(f"a component is beyond {LARGEST // scale} in size")
        keep[n] = True
        found.append(own.astype("<i4").tobytes())
    return keep, found


class CellMemo:
    """For each part position and grid cell, the entries that may be nearest somewhere in the cell."""

    def __init__(self, books: np.ndarray, cell: int = CELL, keep: int = KEEP_CELLS):
        self.books, self.cell, self.keep = books, cell, keep
        self.known: dict[tuple[int, bytes], np.ndarray] = {}

    def learn(self, part: int, cells: np.ndarray) -> None:
        book = self.books[part][None, :, :]
        for at in range(0, len(cells), VECTORS_AT_ONCE):
            some = cells[at : at + VECTORS_AT_ONCE]
            low = some[:, None, :] * self.cell
            high = low + self.cell - 1
            nearest = np.maximum(np.maximum(low - book, book - high), 0)
            farthest = np.maximum(np.abs(book - low), np.abs(high - book))
            least, most = (nearest**2).sum(axis=2), (farthest**2).sum(axis=2)
            useful = least <= most.min(axis=1, keepdims=True)
            for row, key in zip(useful, some):
                self.known[part, key.tobytes()] = np.flatnonzero(row)

    def entries(self, part: int, cells: np.ndarray) -> list[np.ndarray]:
        """Entries worth comparing, ascending, for each of these distinct cells."""
        keys = [c.tobytes() for c in cells]
        if len(self.known) > self.keep:
            self.known.clear()
        new = np.array([(part, k) not in self.known for k in keys])
        if new.any():
            self.learn(part, cells[new])
        return [self.known[part, k] for k in keys]

    def nearest(self, part: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower one) and squared distance of each part in ``held``."""
        cells, cell_of = np.unique(held // self.cell, axis=0, return_inverse=True)
        entries = self.entries(part, cells)
        sizes = np.array([len(e) for e in entries])
        first = np.cumsum(sizes) - sizes
        cell_of = cell_of.reshape(-1)
        count = sizes[cell_of]
        start = np.cumsum(count) - count
        row = np.repeat(np.arange(len(held)), count)
        entry = np.concatenate(entries)[np.repeat(first[cell_of] - start, count) + np.arange(count.sum())]
        distance = ((held[row] - self.books[part][entry]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(distance, start)
        hits = np.flatnonzero(distance == least[row])
        return entry[hits[np.unique(row[hits], return_index=True)[1]]], least

    def assign(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances (vectors x parts) of whole vectors (vectors x parts x components)."""
        found = [self.nearest(p, values[:, p]) for p in range(values.shape[1])]
        return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as (vectors, parts, components) integers."""
    parts, _, width = shape
    for batch in batches:
        for at in range(0, batch.num_rows, VECTORS_AT_ONCE):
            some = batch.slice(at, VECTORS_AT_ONCE)
            held = some.column("values").to_pylist()
            if any(len(h) != 4 * parts * width for h in held):
                raise ValueError("vectors differ in length")
            yield some, np.frombuffer(b"".join(held), dtype="<i4").astype(np.int64).reshape(-1, parts, width)


def kept_vectors(vectors: DataFrame, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, values binary): the vectors that are not dropped, as integers."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    schema = StructType([*rows.schema.fields[:2], StructField("values", BinaryType())])

    def run(batches):
        for batch in batches:
            keep, found = integer_components(batch.column(2), scale)
            held = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([held.column(0), held.column(1), pa.array(found, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def updated(kept: DataFrame, books: np.ndarray, cell: int) -> np.ndarray:
    """Codebooks after one round: every entry the floor of its parts' mean, unused ones as they were."""
    parts, entries, width = books.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("held", pa.int64()), *[(f"s{i}", pa.int64()) for i in range(width)]])

    def run(batches):
        memo, sums = CellMemo(books, cell), np.zeros((parts, entries, width + 1), dtype=np.int64)
        for _, values in _blocks(batches, books.shape):
            codes, _ = memo.assign(values)
            for p in range(parts):
                sums[p, :, 0] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p, :, 1:], codes[:, p], values[:, p])
        part, entry = np.nonzero(sums[:, :, 0])
        used = sums[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), *[pa.array(used[:, i]) for i in range(width + 1)]], schema=schema
        )

    columns = ", ".join(["part int", "entry int", "held long", *[f"s{i} long" for i in range(width)]])
    rows = kept.select("values").mapInArrow(run, columns)
    totals = rows.groupBy("part", "entry").agg(F.sum("held"), *[F.sum(f"s{i}") for i in range(width)])
    after = books.copy()
    for part, entry, held, *sums in totals.collect():  # one row per entry at most
        after[part, entry] = [s // held for s in sums]
    return after


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame,
    store: Storage,
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    cell: int = CELL,
) -> tuple[DataFrame, np.ndarray]:
    """Every kept vector with its codes, and the codebooks (parts x entries x components).

    Rows: vec_id, label, code (two hex digits per part), error (squared distance to what the code stands for, in
    integer units), label_error (errors of all vectors of that label, null labels together). Dropped are rows whose
    vector is null or holds null or non-finite components. The codebooks start as the vectors of the smallest vec_ids,
    null ids last; rows of one id count by their components' bytes. Rows that repeat stay apart and count as often as
    they occur. Fewer vectors than ``entries`` give shorter codebooks. An empty table gives no rows and empty codebooks. All kept vectors must have the
    same length, a multiple of ``parts``; else this raises. Other columns are ignored. What reaches the driver is one
    row per codebook entry. Codes have two hex digits, so ``entries`` is at most 256.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    store = own_store(store)
    kept = store.table("kept", kept_vectors(vectors, vector, label, scale))
    first = [bytes(r[0]) for r in kept.orderBy(F.asc_nulls_last("vec_id"), "values").limit(entries).select("values").collect()]
    sizes = {len(f) for f in first}
    if len(sizes) > 1 or any(s == 0 or s % (4 * parts) for s in sizes):
        raise ValueError(f"vectors need one common length that is a multiple of {parts}")
    books = np.frombuffer(b"".join(first), dtype="<i4").astype(np.int64)
    books = np.ascontiguousarray(books.reshape(len(first), parts, -1 if len(first) else 0).swapaxes(0, 1))
    for _ in range(rounds if first else 0):
        books = updated(kept, books, cell)

    schema = StructType([*kept.schema.fields[:2], *StructType.fromDDL("code string, error long").fields])

    def code(batches):
        memo = CellMemo(books, cell)
        digits = np.array([f"{n:02x}" for n in range(256)], dtype="S2")
        for some, values in _blocks(batches, books.shape):
            codes, distance = memo.assign(values)
            text = digits[codes].view(f"S{2 * books.shape[0]}").reshape(-1).astype(str)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(text.tolist(), pa.string()), pa.array(distance.sum(axis=1))], names=schema.names
            )

    coded = store.table("coded", kept.mapInArrow(code, schema))
    known = {"no_label": F.col("label").isNull(), "label_text": F.coalesce(F.col("label").cast("string"), F.lit(""))}
    sums = store.table("labels", coded.groupBy(*[c.alias(n) for n, c in known.items()]).agg(F.sum("error").alias("label_error")))
    out = lookup_join(coded.withColumns(known), sums, list(known), ["vec_id", "code"], max_rows=sums.count())
    return out.select("vec_id", "label", "code", F.col("error").cast(LongType()).alias("error"), "label_error"), books
