"""Near duplicates by SimHash, with an exact tiled comparison of all distinct fingerprints.

A fingerprint has ``64 * seeds`` bits: bit b of a seed's word is set if it is set in over half of
the hashes of the text's shingles. Distinct fingerprints are cut into tiles by the population
counts of their four quarters, in steps of the radius. Fingerprints within the radius differ by at
most the radius in the sum of those counts' differences, so other pairs of tiles are skipped. The
rest are compared by numpy exclusive-or and bit counts, every pair of their rows. A crowded tile is
cut further by hash, and each pair of parts is a cell of its own, so that no task has all of it.
From a cell only links that join something not yet joined within it are kept: a dense group of
copies yields a link for each, not all pairs. Linked fingerprints are grouped by their smallest
member with alternating star contractions.

With a ``similarity`` those groups are candidates only. Fingerprints are then those of distinct
shingles. The shingle sets of each candidate group are compared exactly, in cells of bounded size
again, and what is linked there is grouped in the same way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import fresh_name, lower_words, numbered, own_store, partitions, whole_text, with_stable_row_id
from demandcast.sources.storage import Storage

SHINGLE = 3
SEEDS = (42,)
RADIUS = 2
QUARTERS = 4
#: A tile with more fingerprints is cut into parts of about this many, and into sqrt(2 * shuffle partitions) at most.
TILE = 8192
#: Pairs compared at a time.
PAIRS_AT_ONCE = 1 << 21
HASHES_AT_ONCE = 1 << 16
#: A candidate group with more shingle sets is cut into parts of about this many, and into sqrt(2 * shuffle partitions) at most.
SETS = 256


def _shingles(text: str, shingle: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The text's words joined by blanks, and from where to where each shingle is in them."""
    words = lower_words(text)
    if not words:
        return b"", []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = min(shingle, len(words))
    return joined, list(zip(starts[: len(words) - length + 1].tolist(), ends[length - 1 :].tolist()))


def fingerprint(text: str, shingle: int = SHINGLE, seeds: tuple[int, ...] = SEEDS, distinct: bool = False) -> bytes:
    """Fingerprint of a whole text, 8 bytes a seed, highest bit first; zero without words.

    ``distinct`` counts a shingle once, however often it occurs.
    """
    joined, pairs = _shingles(text, shingle)
    if not pairs:
        return bytes(8 * len(seeds))
    if distinct:
        pairs = list({joined[a:b]: (a, b) for a, b in pairs}.values())
    out = []
    for seed in seeds:
        hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
        for at in range(0, len(pairs), HASHES_AT_ONCE):
            some = np.array([hashed(joined[a:b], seed) for a, b in pairs[at : at + HASHES_AT_ONCE]], dtype=">u8")
            counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * counts > len(pairs)).tobytes())
    return b"".join(out)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of a text's distinct shingles, sorted."""
    joined, pairs = _shingles(text, shingle)
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in pairs], dtype="<u8"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two shingle sets; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def fingerprint_rows(docs: DataFrame, shingle: int, seeds: tuple[int, ...], distinct: bool = False, row: str | None = None) -> DataFrame:
    """(row, doc_id, fingerprint binary) of every row; columns other than doc_id and text are ignored.

    With ``distinct`` also ``set_id``, 16 bytes that are the same for equal shingle sets.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fingerprint", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            prints = [fingerprint(t, shingle, seeds, distinct) for t in texts]
            out = [batch.column(0), batch.column(1), pa.array(prints, pa.binary())]
            if distinct:
                sets = [hashlib.blake2b(shingle_set(t, shingle).tobytes(), digest_size=16).digest() for t in texts]
                yield pa.RecordBatch.from_arrays([*out, pa.array(sets, pa.binary())], names=[*schema.names, "set_id"])
            else:
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    rows = numbered(docs, row, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    columns = "row long, doc_id long, fingerprint binary" + (", set_id binary" if distinct else "")
    return rows.select("row", "doc_id", "text").mapInArrow(run, columns)


def _as_words(joined: bytes, size: int) -> np.ndarray:
    return np.frombuffer(joined, dtype=">u8").reshape(-1, size // 8).astype(np.uint64)


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Steps between tiles that may hold fingerprints within ``radius``, one of each mirrored pair.

    Counts whose steps of ``radius`` differ by e differ by (e - 1) * radius + 1 at least.
    """
    least = {0: 0, 1: 1, 2: max(1, radius) + 1}
    every = [d for d in product(range(-2, 3), repeat=QUARTERS) if sum(least[abs(x)] for x in d) <= radius]
    return [d for d in every if d >= (0,) * QUARTERS]


def _tile(size: int, radius: int) -> Column:
    """Population counts of the quarters of a binary fingerprint in steps of ``radius``."""
    quarter = size // QUARTERS

    def ones(q: int) -> Column:
        parts = range(q * quarter, (q + 1) * quarter, min(quarter, 4))
        values = [F.conv(F.hex(F.substring("fingerprint", at + 1, min(quarter, 4))), 16, 10).cast("long") for at in parts]
        return reduce(lambda a, b: a + b, [F.bit_count(v) for v in values])

    return F.array(*[(F.floor(ones(q) / max(1, radius))).cast("int") for q in range(QUARTERS)])


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links (row of left, row of right) within the radius that join all that is linked in the two tiles."""
    n, m = len(left), len(right)
    label = np.arange(n) if same else np.arange(n + m)
    shift = 0 if same else n
    links: list[tuple[int, int]] = []
    height = max(1, PAIRS_AT_ONCE // max(1, m))
    for at in range(0, n, height):
        stripe = left[at : at + height]
        distance = np.zeros((len(stripe), m), dtype=np.uint16)
        for w in range(left.shape[1]):
            distance += np.bitwise_count(stripe[:, w, None] ^ right[None, :, w])
        near = distance <= radius
        if same:
            near &= np.arange(m)[None, :] > (at + np.arange(len(stripe)))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[i])
            own, theirs = label[at + i], label[others + shift]
            joins, first = np.unique(theirs, return_index=True)
            fresh = joins != own
            for j in others[first[fresh]]:
                links.append((at + int(i), int(j)))
            if fresh.any():
                label[np.isin(label, joins)] = own
    return links


def near_links(prints: DataFrame, size: int, radius: int, store: Storage) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column ``fingerprint``, ``size`` bytes) within ``radius``.

    They connect everything that is within the radius; links that close a ring inside a cell are left out.
    """
    n = partitions(prints.sparkSession)
    tiled = prints.select("fingerprint", _tile(size, radius).alias("tile"))
    parts = F.least(F.lit(math.ceil(math.sqrt(2 * n))), F.ceil(F.col("held") / TILE)).cast("int")
    crowds = tiled.groupBy("tile").agg(F.count("*").alias("held")).select("tile", parts.alias("parts"))
    crowds = store.table("crowds", crowds)
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    steps = F.array(*[F.array(*[F.lit(x) for x in d]) for d in _neighbours(radius)])
    toward = tiled.withColumn("step", F.explode(steps)).select(
        "fingerprint",
        F.zip_with("tile", "step", lambda a, b: a + b).alias("tile"),
        F.forall("step", lambda x: x == 0).alias("own"),
    )
    cell = ["tile", "own", "line", "pile"]
    # within a tile the cells (line, pile) and (pile, line) compare the same pairs
    left = toward.join(crowds, "tile").withColumn("line", part).withColumn("pile", each)
    left = left.where("not own or line <= pile").select(*cell, "fingerprint")
    right = tiled.join(crowds, "tile").withColumn("pile", part).withColumn("line", each)
    right = right.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    theirs_cell = [f"right_{c}" for c in cell]
    right = right.where("not own or line <= pile").select(
        *[F.col(c).alias(x) for c, x in zip(cell, theirs_cell)], F.col("fingerprint").alias("right_fingerprint")
    )

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        a, b = sorted(ours.column("fingerprint").to_pylist()), sorted(theirs.column("right_fingerprint").to_pylist())
        found = []
        if a and b:
            same = ours.column("own")[0].as_py() and ours.column("line")[0] == ours.column("pile")[0]
            found = spanning_links(_as_words(b"".join(a), size), _as_words(b"".join(b), size), radius, same)
        return pa.table(
            {"a": pa.array([a[i] for i, _ in found], pa.binary()), "b": pa.array([b[j] for _, j in found], pa.binary())}
        )

    # a cell's work is not its bytes, so partitions are not to be coalesced
    left, right = left.repartition(2 * n, *cell), right.repartition(2 * n, *theirs_cell)
    return left.groupBy(*cell).cogroup(right.groupBy(*theirs_cell)).applyInArrow(compare, "a binary, b binary")


def smallest_linked(links: DataFrame, store: Storage) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches. ``links`` has columns a, b of one type.

    Large-star and small-star contractions take turns until nothing changes. Each is a minimum per
    node, which is summed up before the shuffle, and a join back that may be split where a node has
    many links. Rounds are stored, so lineage does not grow.
    """
    edges = store.table("edges0", links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, round_ = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = store.table(f"least{round_}a", both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = store.table(f"large{round_}", large.where("u <> v").distinct())
        low = store.table(f"least{round_}b", large.groupBy("u").agg(F.min("v").alias("low")))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
        round_ += 1
        edges = store.table(f"edges{round_}", small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
        before = now


def similar_links(members: DataFrame, docs: DataFrame, row: str, shingle: int, size: int, radius: int, similarity: float, store: Storage) -> DataFrame:
    """Links (a, b) among the shingle sets of each candidate group, within ``radius`` and of ``similarity`` or more.

    ``members`` has group, set_id, fingerprint and row, the number (column ``row`` of ``docs``) of one with that set. The links
    connect everything that is so linked; those that close a ring inside a cell are left out.
    """
    crowds = members.groupBy("group").agg(F.count("*").alias("held")).where("held > 1")
    most = math.ceil(math.sqrt(2 * partitions(docs.sparkSession)))
    parts = F.least(F.lit(most), F.ceil(F.col("held") / SETS)).cast("int")
    wanted = members.join(crowds.select("group", parts.alias("parts")), "group")
    wanted = store.table("wanted", wanted.withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")))
    columns = ["group", "parts", "part", "set_id", "fingerprint"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle).tobytes() for t in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sets, pa.binary())], names=[*columns, "shingles"])

    texts = numbered(docs, row, whole_text().alias("text")).join(wanted, "row").select(*columns, "text")
    sets = store.table(
        "sets", texts.mapInArrow(cut, "group binary, parts int, part int, set_id binary, fingerprint binary, shingles binary")
    )
    # the cells (line, pile) of a group, line <= pile: every pair of its parts once
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = sets.withColumn("other", other).withColumns(
        {"line": F.least("part", "other"), "pile": F.greatest("part", "other")}
    )

    def compare(held: pa.Table) -> pa.Table:
        held = held.sort_by("set_id")
        ids, part = held.column("set_id").to_pylist(), held.column("part").to_numpy()
        prints = _as_words(b"".join(held.column("fingerprint").to_pylist()), size)
        shingles = [np.frombuffer(x, dtype="<u8") for x in held.column("shingles").to_pylist()]
        crossing = held.column("line")[0] != held.column("pile")[0]
        label, links = np.arange(len(ids)), []
        for i in range(len(ids) - 1):
            near = np.bitwise_count(prints[i + 1 :] ^ prints[i]).sum(axis=1) <= radius
            if crossing:
                near &= part[i + 1 :] != part[i]
            for j in (i + 1 + np.flatnonzero(near)).tolist():
                if label[i] == label[j]:
                    continue
                few, many = sorted((len(shingles[i]), len(shingles[j])))
                if many and few / many >= similarity and jaccard(shingles[i], shingles[j]) >= similarity:
                    links.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

    # a cell's work is not its bytes, so partitions are not to be coalesced
    cells = cells.select("group", "line", "pile", "part", "set_id", "fingerprint", "shingles")
    cells = cells.repartition(2 * partitions(docs.sparkSession), "group", "line", "pile")
    return cells.groupBy("group", "line", "pile").applyInArrow(compare, "a binary, b binary")


def _rooted(nodes: DataFrame, name: str, links: DataFrame, store: Storage) -> DataFrame:
    """``nodes`` with ``root``: the smallest node that column ``name`` reaches over the links, itself without any."""
    roots = store.table(f"{name}_roots", smallest_linked(links, own_store(store)))
    return nodes.join(roots, F.col(name) == F.col("node"), "left").withColumn("root", F.coalesce("root", name)).drop("node")


def near_groups(
    docs: DataFrame,
    store: Storage,
    shingle: int = SHINGLE,
    seeds: tuple[int, ...] = SEEDS,
    radius: int = RADIUS,
    similarity: float | None = None,
    row: str | None = None,
) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and group: row, doc_id, fingerprint, root, component_id.

    ``component_id`` is the smallest doc_id reachable over fingerprints that differ in at most
    ``radius`` bits. Texts without words have fingerprint zero and link like any other. A null
    text counts as empty, a null doc_id is no candidate for the smallest (a group with null ids
    alone has null). An empty table gives no rows.

    With ``similarity`` a link also needs a Jaccard similarity of the two sets of distinct shingles of
    that much or more (their 64-bit hashes stand for the shingles), and texts without words link to
    each other only. ``docs`` is read again then. ``row`` names a column that has the row numbers.
    """
    store, size, exact = own_store(store), 8 * len(seeds), similarity is not None
    if exact and row is None:
        row = fresh_name(docs, "row")
        docs = with_stable_row_id(docs, row, store)
    rows = store.table("prints", fingerprint_rows(docs, shingle, seeds, exact, row))
    distinct = store.table("distinct", rows.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")))
    node = "set_id" if exact else "fingerprint"
    placed = _rooted(distinct, "fingerprint", near_links(distinct, size, radius, store), store)
    if exact:
        groups = store.table("candidates", placed.select("fingerprint", F.col("root").alias("group")))
        one = rows.groupBy("set_id", "fingerprint").agg(F.min("doc_id").alias("lowest"), F.min("row").alias("row"))
        members = store.table("members", one.join(groups, "fingerprint"))
        links = similar_links(members.drop("lowest"), docs, row, shingle, size, radius, similarity, store)
        placed = _rooted(members.select("set_id", "lowest"), "set_id", links, store)
    placed = store.table("placed", placed.select(node, "lowest", "root"))
    groups = store.table("groups", placed.groupBy("root").agg(F.min("lowest").alias("component_id")))
    known = store.table("known", placed.join(groups, "root").select(node, "root", "component_id"))
    return rows.join(known, node).select("row", "doc_id", "fingerprint", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, store: Storage, **options) -> DataFrame:
    """One row of ``docs`` for each group, that of the smallest doc_id (null last); all columns.

    ``docs`` has to be a stored table: it is read again.
    """
    row = fresh_name(docs, "row")
    rows = with_stable_row_id(docs, row, store)
    groups = near_groups(rows, store, row=row, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    kept = groups.groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
