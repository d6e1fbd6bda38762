import hashlib
import math

import numpy as np
import pytest

from demandcast.llm import vector_codes
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error double, part int"


def by_hand(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error) of the kept rows and all codebook numbers, by plain loops."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, np.array(kept[n][1], "<i4").tobytes()))[:entries]
    books = [[list(cut[n][p]) for n in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for v in cut:
                own[nearest(p, v[p])[1]].append(v[p])
            for k, held in enumerate(own):
                if held:
                    books[p][k] = [sum(c) // len(held) for c in zip(*held)]
    out = []
    for (i, _, label), v in zip(kept, cut):
        found = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, [x for book in books for e in book for x in e]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def check(got, rows, **options):
    want, _ = by_hand(rows, **options)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert order((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got) == order((*w, sums[w[1]]) for w in want)


def test_query_against_plain_loops(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = QUERIES["op13_vector_codes"](spark, SF_DIR).collect()
    want, books = by_hand(rows)
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((i, c, e) for i, _, c, e in want)


@pytest.mark.parametrize("cell", [1, 7, 64, 5000])
def test_awkward_rows(spark, store, cell):
    rng = np.random.default_rng(1)
    rows = [(n, rng.normal(0, 0.3, 8).astype("f4").tolist(), n % 3) for n in range(90)]
    rows += [(5, [0.5] * 8, 1), (5, [-0.5] * 8, None), (5, [-0.5] * 8, None), (None, [1.0] * 8, None), (None, [3000.0] + [0.0] * 7, 4)]
    rows += [(200, None, 1), (201, [None] + [0.0] * 7, 1), (202, [math.nan] + [0.0] * 7, 1), (203, [math.inf] + [0.0] * 7, 1), (204, [0.0] * 8, 9)]
    # ties between entries, and entries that nothing uses
    rows += [(-n, [0.25 * (n % 2)] * 8, 7) for n in range(1, 9)]
    full = [(i, v, label, "c", 0.0, 1) for i, v, label in rows]
    table = spark.createDataFrame(full, SCHEMA).repartition(5)
    got, books = vector_codes.compress_vectors(table, store, parts=4, entries=12, cell=cell)
    check(got.collect(), rows, parts=4, entries=12)
    assert books.reshape(-1).tolist() == by_hand(rows, parts=4, entries=12)[1]


def test_few_cells_are_remembered(monkeypatch):
    rng = np.random.default_rng(3)
    books, values = rng.integers(-90, 90, (2, 20, 3)), rng.integers(-120, 120, (500, 2, 3))
    memo = vector_codes.CellMemo(books, 16, keep=3)
    for at in range(0, 500, 50):
        codes, distance = memo.assign(values[at : at + 50])
        every = ((values[at : at + 50, :, None] - books[None]) ** 2).sum(axis=3)
        assert (codes == every.argmin(axis=2)).all() and (distance == every.min(axis=2)).all()


def test_empty_and_unequal(spark, store):
    none = spark.createDataFrame([], SCHEMA)
    got, books = vector_codes.compress_vectors(none, store)
    assert got.count() == 0 and books.size == 0
    assert vector_codes.compress_vectors(spark.createDataFrame([(1, None, 1, "", 0.0, 1)], SCHEMA), store)[0].count() == 0
    with pytest.raises(ValueError, match="multiple"):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [0.0] * 5, 1, "", 0.0, 1)], SCHEMA), store)
