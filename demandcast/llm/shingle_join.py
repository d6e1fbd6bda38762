"""Exact self-join of texts by the Jaccard similarity of their sets of word shingles.

Equal sets are joined first and stand as one. Shingles are put in one order for all sets, rarest
first. Two sets that are similar enough share one of their first shingles, as many as a set may lack
of a similar one and one more, so sets are dealt to tiles by those. Within a tile sets are in order
of size and only bands of sizes that can be similar meet. Tiles with the same sets in them are one.
Each set has a bitmap, as wide as its size asks for, with one bit for every hash value of its
shingles: bits that the other lacks bound the overlap from above, and pairs that stay below the
bound are skipped. A crowded tile is cut into parts, and each pair of parts is a
cell of its own. What is left groups the sets; within a group (cut by bytes in the same way) the
bitmaps are compared again and sorted arrays of shingles are intersected exactly. Everywhere only
links that join something not yet joined in the cell are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import lower_words, own_store, partitions, whole_text, with_row_id
from demandcast.llm.runs import starts_of, whole_runs
from demandcast.llm.simhash import smallest_linked
from demandcast.operators.joins import SPREAD_FINE, lookup_join
from demandcast.sources.storage import Storage

SHINGLE = 5
PERCENT = 80
#: A bitmap has at least twice as many bits as its set has shingles, within these limits (powers of two).
LEAST_BITS, MOST_BITS = 64, 1 << 17
#: Counters of shingles by hash, 4 bytes each, which the driver holds and broadcasts: a fixed size.
COUNTERS = 1 << 20
COUNTER_SLICES = 256
WORDS_AT_ONCE = 1 << 20
#: Texts that a task holds cut into shingles at a time.
TEXTS_AT_ONCE = 500
#: Sets in a part of a tile, and bytes of shingles in a part of a group.
TILE = 2048
GROUP_BYTES = 16 << 20
#: Rows of two or three numbers that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# fixed values: odd multipliers of a shingle's word hashes, and of the final mix
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def shingle_array(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles; with fewer words the whole sequence is one, without any none."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, dtype="<u8")
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    length = min(shingle, len(words))
    count = len(words) - length + 1
    held = np.full(count, length, dtype=np.uint64)
    for i in range(length):
        # each place has a multiplier of its own, and places beyond the table take mixed ones
        by = np.uint64(MULTIPLIERS[i]) if i < len(MULTIPLIERS) else np.uint64(xxhash.xxh64_intdigest(str(i)) | 1)
        held = _mixed(held * np.uint64(MULTIPLIERS[0]) + hashed[i : i + count] * by)
    return np.unique(held).astype("<u8")


def least_overlap(size, percent: int = PERCENT):
    """Shingles that a set of this size shares at least with any set that is similar enough."""
    return -(-percent * size // 100)


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit for each hash value of the shingles."""
    width = min(max(LEAST_BITS, 1 << (2 * len(shingles) - 1).bit_length()), MOST_BITS)
    bits = np.zeros(width, dtype=bool)
    bits[((shingles >> np.uint64(24)) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


class Bitmaps:
    """Bitmaps of some sets; of a pair, the wider one is folded to the width of the other."""

    def __init__(self, bitmaps: list[bytes], sizes: np.ndarray):
        self.sizes = sizes
        self.width = np.array([len(b) for b in bitmaps], dtype=np.int64)
        self.place = np.zeros(len(bitmaps), dtype=np.int64)
        self.held: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            self.place[own] = np.arange(len(own))
            self.held[w, w] = np.frombuffer(b"".join([bitmaps[n] for n in own]), dtype="<u8").reshape(len(own), w // 8)

    def folded(self, width: int, to: int) -> np.ndarray:
        if (width, to) not in self.held:
            wide = self.folded(width, 2 * to)
            self.held[width, to] = wide[:, : to // 8] | wide[:, to // 8 :]
        return self.held[width, to]

    def most_overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bound from above of the overlaps of pairs: each bit that the other lacks is a shingle that the other lacks."""
        most = np.minimum(self.sizes[a], self.sizes[b])
        kinds = self.width[a] * (2 * MOST_BITS) + self.width[b]
        for kind in np.unique(kinds).tolist():
            wide_a, wide_b = divmod(kind, 2 * MOST_BITS)
            to, pairs = min(wide_a, wide_b), np.flatnonzero(kinds == kind)
            left, right = self.folded(wide_a, to), self.folded(wide_b, to)
            at_once = max(1, WORDS_AT_ONCE // (to // 8))
            for at in range(0, len(pairs), at_once):
                some = pairs[at : at + at_once]
                x, y = left[self.place[a[some]]], right[self.place[b[some]]]
                only_x = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
                only_y = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
                most[some] = np.minimum(self.sizes[a[some]] - only_x, self.sizes[b[some]] - only_y)
        return most


def similar(overlap, n_a, n_b, percent: int = PERCENT):
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def overlap_of(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


class Joined:
    """Which of some nodes are joined already; labels are those of the smallest node."""

    def __init__(self, nodes: int):
        self.label = np.arange(nodes)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = np.minimum(self.label[a], self.label[b]), np.maximum(self.label[a], self.label[b])
            if (low == high).all():
                return
            np.minimum.at(self.label, high, low)
            while True:
                further = self.label[self.label]
                if (further == self.label).all():
                    break
                self.label = further


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def shingle_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """(row, doc_id, size, set_id, shingles) of every row: equal sets have equal 16-byte ids."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("set_id", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            found = [shingle_array(t, shingle) for t in batch.column(2).to_pylist()]
            held = [f.tobytes() for f in found]
            ids = [hashlib.blake2b(h, digest_size=16).digest() for h in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(map(len, found), pa.int64()), pa.array(ids, pa.binary()), pa.array(held, pa.binary())],
                schema=schema,
            )

    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), "row")
    return rows.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, size long, set_id binary, shingles binary")


def shingle_counts(rows: DataFrame) -> np.ndarray:
    """How many sets hold shingles of each hash value, over all rows. Their order by rarity changes speed, not results."""
    width = COUNTERS // COUNTER_SLICES

    def count(batches):
        held = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in _small(batches):
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u8")
            held += np.bincount((flat & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        slices = [held[n * width : (n + 1) * width].tobytes() for n in range(COUNTER_SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(COUNTER_SLICES), pa.int32()), pa.array(slices, pa.binary())], names=["slice", "held"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(held, dtype="<u4").astype(np.uint64)
                total[n] = np.minimum(total[n] + more, np.uint64(0xFFFFFFFF)) if n in total else more
        sums = [t.astype("<u4").tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(sums, pa.binary())], names=["slice", "held"])

    counted = rows.select("shingles").mapInArrow(count, "slice int, held binary")
    totals = counted.repartition(partitions(rows.sparkSession), "slice").mapInArrow(add, "slice int, held binary")
    out = np.zeros(COUNTERS, dtype=np.uint32)
    for n, held in totals.collect():  # a fixed number of rows
        out[n * width : (n + 1) * width] = np.frombuffer(held, dtype="<u4")
    return out


def first_shingles(rows: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(row, size, bits, tokens): bitmap and rarest shingles of every set that has any."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        counts = shared.value
        for batch in _small(batches):
            bits, tokens, sizes = [], [], batch.column(1).to_pylist()
            for held, size in zip(batch.column(2).to_pylist(), sizes):
                own = np.frombuffer(held, dtype="<u8")
                order = np.lexsort((own, counts[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]))
                tokens.append(own[order[: size - least_overlap(size, percent) + 1]].view("<i8"))
                bits.append(bitmap(own))
            ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, dtype="<i8")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary()), lists], names=["row", "size", "bits", "tokens"])

    return rows.where("size > 0").select("row", "size", "shingles").mapInArrow(run, "row long, size long, bits binary, tokens array<long>")


def tile_links(tiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of sets that may be similar by sizes and bitmaps; they connect all such pairs of each tile.

    ``tiles``: token, parts (of the token's tile), row, size, bits.
    """
    n = partitions(tiles.sparkSession)
    cells = _cells(tiles, n, ["token"], ["row", "size", "bits"])

    def compare(batches):
        for held in whole_runs(batches, ["token", "line", "pile"]):
            run = np.cumsum(starts_of(held, ["token", "line", "pile"]))
            rows, size, part = (held.column(c).to_numpy() for c in ("row", "size", "part"))
            own = held.column("line").to_numpy() == held.column("pile").to_numpy()
            nodes, first, node = np.unique(rows, return_index=True, return_inverse=True)
            bits = Bitmaps(held.column("bits").take(pa.array(first)).to_pylist(), size[first])
            joined, out_a, out_b = Joined(len(nodes)), [], []
            at, step = np.arange(len(rows) - 1), 1
            while len(at := at[at + step < len(rows)]):
                to = at + step
                band = (run[at] == run[to]) & (100 * size[at] >= percent * size[to])
                at, to = at[band], to[band]
                fresh = (joined.label[node[at]] != joined.label[node[to]]) & (own[at] | (part[at] != part[to]))
                a, b = at[fresh], to[fresh]
                near = similar(bits.most_overlap(node[a], node[b]), size[a], size[b], percent)
                if near.any():
                    a, b = a[near], b[near]
                    out_a.append(rows[a])
                    out_b.append(rows[b])
                    joined.join(node[a], node[b])
                step += 1
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return cells.mapInArrow(compare, "a long, b long")


def _cells(rows: DataFrame, n: int, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of each key dealt to cells (line, pile) of its ``parts``, every pair of parts once; sorted by cell and size."""
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = rows.withColumn("part", part).withColumn("other", other)
    dealt = dealt.withColumns({"line": F.least("part", "other"), "pile": F.greatest("part", "other")})
    cell = [*keys, "line", "pile"]
    # a cell's work is not its bytes, so partitions are not to be coalesced
    return dealt.select(*cell, "part", *columns).repartition(2 * n, *cell).sortWithinPartitions(*cell, "size", "row")


def exact_links(groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of sets that are similar enough; they connect all such pairs of each group.

    ``groups``: root, parts, row, size, shingles.
    """
    cells = _cells(groups, partitions(groups.sparkSession), ["root"], ["row", "size", "shingles"])
    keys = ["root", "line", "pile"]

    def compare(batches):
        for held in whole_runs(batches, keys):
            starts = np.flatnonzero(starts_of(held, keys))
            rows, size, part, line, pile = (held.column(c).to_numpy() for c in ("row", "size", "part", "line", "pile"))
            sets = [np.frombuffer(s, dtype="<u8") for s in held.column("shingles").to_pylist()]
            links = []
            for first, end in zip(starts, np.append(starts[1:], len(rows))):
                crossing = line[first] != pile[first]
                joined = Joined(end - first)
                own, own_part = size[first:end], part[first:end]
                bits = Bitmaps([bitmap(s) for s in sets[first:end]], own)
                for i in range(end - first - 1):
                    upto = i + 1 + int(np.searchsorted(percent * own[i + 1 :], 100 * own[i], side="right"))
                    open_ = joined.label[i + 1 : upto] != joined.label[i]
                    if crossing:
                        open_ &= own_part[i + 1 : upto] != own_part[i]
                    to = i + 1 + np.flatnonzero(open_)
                    to = to[similar(bits.most_overlap(np.full(len(to), i), to), own[i], own[to], percent)]
                    for j in to.tolist():
                        if joined.label[i] == joined.label[j]:
                            continue
                        if similar(overlap_of(sets[first + i], sets[first + j]), int(own[i]), int(own[j]), percent):
                            links.append((rows[first + i], rows[first + j]))
                            joined.join(np.array([i]), np.array([j]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cells.mapInArrow(compare, "a long, b long")


def _few(rows: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if its row count is within the limit."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def jaccard_groups(docs: DataFrame, store: Storage, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Every row of ``docs`` with doc_id, n_shingles (size of its set) and component_id.

    Two rows link when 100 * size of the intersection >= ``percent`` * size of the union; ``component_id`` is the
    smallest doc_id reachable. A null text counts as empty; a set without shingles links with nothing and has its own
    doc_id. A null doc_id is no candidate for the smallest (a group with null ids alone has null). Repeated rows stay
    apart, other columns are ignored, an empty table gives no rows. Shingles are told apart by 64-bit hashes.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    store = own_store(store)
    rows = store.table("rows", shingle_rows(docs, shingle))
    sets = store.table("sets", rows.where("size > 0").groupBy("set_id").agg(F.min("row").alias("row"), F.min("doc_id").alias("lowest")))

    counts = shingle_counts(rows)
    first = store.table("first", first_shingles(rows, counts, percent).join(_few(sets.select("row")), "row", "left_semi"))
    tokens = first.select("row", F.explode("tokens").alias("token"))
    # tiles of the same sets are one: the sets of a tile are told by two 64-bit sums of their hashes
    marks = [F.bit_xor(F.xxhash64("row", F.lit(n))).alias(f"mark{n}") for n in (1, 2)]
    held = tokens.groupBy("token").agg(F.count("*").alias("held"), *marks).where("held > 1")
    shared = held.groupBy("held", "mark1", "mark2").agg(F.min("token").alias("token"))
    shared = store.table("shared", shared.select("token", F.ceil(F.col("held") / TILE).cast("int").alias("parts")))
    hits = tokens.join(_few(shared), "token").join(first.select("row", "size", "bits"), "row")
    links = store.table("links", tile_links(hits.select("token", "parts", "row", "size", "bits"), percent).distinct())

    linked = smallest_linked(links, own_store(store)).select(F.col("node").alias("row"), "root")
    near = store.table("near", linked.unionByName(linked.select(F.col("root").alias("row"), "root").distinct()))
    sized = near.join(first.select("row", "size"), "row")
    parts = F.ceil(F.sum("size") * 8 / GROUP_BYTES).cast("int")
    large = store.table("large", sized.groupBy("root").agg(parts.alias("parts")).where("parts > 1"))
    near = lookup_join(near, large, ["root"], ["row"], max_rows=large.count()).withColumn("parts", F.coalesce("parts", F.lit(1)))
    groups = rows.select("row", "size", "shingles").join(_few(near), "row")
    exact = store.table("exact", exact_links(groups, percent))

    roots = store.table("roots", smallest_linked(exact, own_store(store)).withColumnRenamed("node", "row"))
    placed = store.table("placed", sets.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")))
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    known = store.table("known", lookup_join(placed, lowest, ["root"], ["row"], spread=SPREAD_FINE).select("set_id", "component_id"))
    out = lookup_join(rows.select("doc_id", "size", "set_id", "row"), known, ["set_id"], ["row"], spread=SPREAD_FINE)
    alone = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), alone.alias("component_id"))
