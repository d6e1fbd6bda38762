import random
import re

import numpy as np
import pytest

from demandcast.llm import shingle_join
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF_DIR, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, length=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(found[i : i + length]) for i in range(max(1, len(found) - length + 1))} if found else set()


def by_hand(rows, length=5, percent=80):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [shingles(t, length) for _, t in rows]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            low[find(n)] = min(low.get(find(n), i), i)
    return [(i, len(sets[n]), low.get(find(n))) for n, (i, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def check(got, rows, **options):
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(by_hand(rows, **options))


def near(rng, text, edits):
    held = text.split()
    for _ in range(edits):
        held[rng.randrange(len(held))] = f"edit{rng.random()}"
    return " ".join(held)


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check(QUERIES["op12_shingle_join"](spark, SF_DIR).collect(), rows)


def test_awkward_rows(awkward, store):
    check(shingle_join.jaccard_groups(awkward, store).collect(), AWKWARD)


@pytest.mark.parametrize(("percent", "length"), [(80, 5), (50, 2), (100, 3)])
def test_borders_of_similarity(make_docs, store, monkeypatch, percent, length):
    """Copies with one edit more each, a passage that all share, crowded tiles and groups."""
    monkeypatch.setattr(shingle_join, "TILE", 4)
    monkeypatch.setattr(shingle_join, "GROUP_BYTES", 4_000)
    rng, rows = random.Random(percent), []
    passage = words(60, 99)
    for base in range(4):
        text = words(40 + 60 * base, base)
        for k in range(14):
            rows.append((len(rows), near(rng, text, k // 2)))
            rows.append((len(rows), passage + " " + near(rng, text, k // 3)))
    rows += [(1000 + n, " ".join(f"w{i}" for i in range(n, n + 30))) for n in range(12)]
    rows += [(2000 + n, "a b c d e f g h i j"[: 2 * n]) for n in range(11)]
    check(shingle_join.jaccard_groups(make_docs(rows), store, length, percent).collect(), rows, length=length, percent=percent)


def test_no_rows(no_docs, store):
    assert shingle_join.jaccard_groups(no_docs, store).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 900, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, max(1, n // 5), dtype=np.uint64)]))
        exact = len(np.intersect1d(a, b))
        assert shingle_join.overlap_of(a, b) == exact
        for x, y in ((a, b), (b, a), (a, b[: len(b) // 5 + 1])):
            bits = shingle_join.Bitmaps([shingle_join.bitmap(x), shingle_join.bitmap(y)], np.array([len(x), len(y)]))
            assert len(np.intersect1d(x, y)) <= bits.most_overlap(np.array([0]), np.array([1]))[0] <= min(len(x), len(y))


def test_shingles_are_told_apart():
    assert len(shingle_join.shingle_array("a b c d e f")) == 2
    assert shingle_join.shingle_array("A  b\nc")[0] == shingle_join.shingle_array("a b c")[0] != shingle_join.shingle_array("a c b")[0]
    assert len(shingle_join.shingle_array(" ".join("abcdefghij"), 9)) == 2
