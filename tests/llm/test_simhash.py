import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from demandcast.llm import simhash
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF_DIR, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(text, length=3, seeds=(42,)):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return "0" * 16 * len(seeds)
    runs = [" ".join(found[i : i + length]) for i in range(max(1, len(found) - length + 1))]
    out = ""
    for seed in seeds:
        hashes = [xxhash.xxh64_intdigest(r.encode(), seed) for r in runs]
        out += f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(runs)):016x}"
    return out


def components(prints, ids, radius):
    """Smallest id reachable, by comparing all pairs."""
    values = [int(p, 16) for p in prints]
    group = list(range(len(values)))

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    low = {}
    for n, i in enumerate(ids):
        if i is not None:
            low[root(n)] = min(low.get(root(n), i), i)
    return [low.get(root(n)) for n in range(len(ids))]


@pytest.mark.parametrize(("shingle", "seeds"), [(3, (42,)), (5, (42, 43))])
def test_fingerprint_by_hand(shingle, seeds):
    for _, text in AWKWARD:
        assert simhash.fingerprint(text or "", shingle, seeds).hex() == by_hand(text, shingle, seeds)


@pytest.mark.parametrize(("size", "radius"), [(8, 0), (8, 2), (8, 7), (32, 48)])
def test_every_link_is_kept(spark, store, monkeypatch, size, radius):
    """Random fingerprints with near ones around them, in crowded cells."""
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, (40, size), dtype=np.uint8)
    prints = {bytes(b) for b in base}
    for b in base[:20]:
        for _ in range(12):
            near = np.unpackbits(b)
            near[rng.choice(8 * size, rng.integers(1, radius + 3), replace=False)] ^= 1
            prints.add(np.packbits(near).tobytes())
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 64)
    rows = spark.createDataFrame([(bytearray(p),) for p in sorted(prints)], "fingerprint binary")
    links = store.table("links", simhash.near_links(rows, size, radius, store))
    roots = {bytes(r.node): bytes(r.root) for r in simhash.smallest_linked(links, store).collect()}
    order = sorted(prints)
    want = components([p.hex() for p in order], list(range(len(order))), radius)
    ours = [order.index(roots.get(p, p)) for p in order]
    assert ours == want
    assert links.count() < 6 * len(order)


def test_chains_and_rings(spark, store):
    links = [(f"{n:03d}", f"{n + 1:03d}") for n in range(60)] + [("900", "901"), ("901", "902"), ("902", "900"), ("7x", "7x")]
    found = {r.node: r.root for r in simhash.smallest_linked(spark.createDataFrame(links, "a string, b string"), store).collect()}
    assert found == {f"{n:03d}": "000" for n in range(1, 61)} | {"901": "900", "902": "900"}


def test_groups_of_awkward_rows(awkward, store):
    rows = simhash.near_groups(awkward, store).collect()
    prints = [bytes(r.fingerprint).hex() for r in rows]
    texts = {r.row: r.text for r in awkward.withColumn("row", F.monotonically_increasing_id()).collect()}
    assert prints == [by_hand(texts[r.row]) for r in rows]
    assert [r.component_id for r in rows] == components(prints, [r.doc_id for r in rows], 2)


def test_one_of_each_group_stays(awkward, store):
    kept = simhash.drop_near_duplicates(awkward, store)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 1 and 9 not in ids and ids.count(0) == 1 and 1 not in ids


def test_near_copies_at_the_pipeline_radius(make_docs, store):
    base = words(400, 5).split()
    edited = list(base)
    for at in range(20, 400, 50):  # 8 of 400 words: a similarity of 0.82
        edited[at] = "changed"
    docs = make_docs([(1, " ".join(base)), (2, " ".join(edited)), (3, words(400, 6)), (4, words(30, 7)), (5, words(30, 8))])
    kept = simhash.drop_near_duplicates(docs, store, shingle=5, seeds=(42, 43, 44, 45), radius=48)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_empty_table(no_docs, store):
    assert simhash.near_groups(no_docs, store).count() == 0


def test_query_against_brute_force(spark):
    rows = sorted(QUERIES["op8_simhash"](spark, SF_DIR).collect())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    assert [r.fingerprint for r in rows] == [by_hand(d.text) for d in docs]
    assert [r.component_id for r in rows] == components([r.fingerprint for r in rows], [r.doc_id for r in rows], 2)


def test_links_need_the_similarity(make_docs, store):
    """Copies of each similarity from 0.5 up against an exact comparison of all pairs."""
    docs, base = [], words(400, 21).split()
    for n, edits in enumerate([0, 6, 8, 9, 10, 12, 14, 20]):
        edited = list(base)
        for k in range(edits):
            edited[10 + k * 19] = f"changed{n}x{k}"
        docs.append((n, " ".join(edited)))
    short = words(8, 22)  # 4 shingles, 4 of 5 with one word more
    docs += [(20, short), (21, f"{short} more"), (22, ""), (23, None), (24, f"{short}\n" * 30), (25, words(300, 23))]
    sets = [simhash.shingle_set(t or "", 5) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if simhash.jaccard(sets[i], sets[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    want = {docs[n][0]: min(docs[m][0] for m in range(len(docs)) if group[m] == g) for n, g in enumerate(group)}
    options = {"shingle": 5, "seeds": (42, 43, 44, 45), "radius": 76, "similarity": 0.8}
    found = {r.doc_id: r.component_id for r in simhash.near_groups(make_docs(docs), store, **options).collect()}
    assert found == want and found[21] == 20 and found[24] != 20 and found[7] == 7 and len(set(found.values())) > 5


def test_large_candidate_groups_in_cells(make_docs, store, monkeypatch):
    monkeypatch.setattr(simhash, "SETS", 8)
    base = words(200, 31).split()
    docs = [(n, " ".join([*base[: 10 + n], f"own{n}", *base[11 + n :]])) for n in range(60)]
    options = {"shingle": 5, "seeds": (42, 43, 44, 45), "radius": 76, "similarity": 0.8}
    assert {r.component_id for r in simhash.near_groups(make_docs(docs), store, **options).collect()} == {0}
