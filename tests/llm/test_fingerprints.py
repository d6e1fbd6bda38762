import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from demandcast.llm import fingerprints as fp
from tests.llm.conftest import AWKWARD, words

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values, kinds="q"):
    """Spark's xxhash64 of several numbers: each hash is the seed of the next."""
    seed = 42
    for v, k in zip(values, kinds * len(values) if len(kinds) == 1 else kinds):
        seed = xxhash.xxh64_intdigest(struct.pack("<" + k, v), seed)
    return signed(seed)


def by_hand(text, shingle=5, bins=256, bits=4):
    tokens = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").lower()) if w]
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in tokens]
    if not hashes:
        return []
    runs = [hashes] if len(hashes) < shingle else [hashes[i : i + shingle] for i in range(len(hashes) - shingle + 1)]
    shift = 64 - (bins.bit_length() - 1)
    held = {}
    for run in runs:
        h = chain(run)
        b = (h >> shift) + bins // 2
        held[b] = min(held.get(b, h), h)
    low = (1 << shift) - 1
    dense = []
    for i in range(bins):
        if i in held:
            dense.append(held[i])
            continue
        for t in range(fp.PROBES):
            at = chain([i, t], "ii") % bins
            if at in held:
                dense.append(held[at])
                break
        else:
            dense.append(min((chain([i, b, -1], "iii"), v) for b, v in held.items())[1])
    assert all(v & low != low for v in dense)
    packed, per = [], 64 // bits
    for w in range(bins // per):
        x = 0
        for v in dense[w * per : (w + 1) * per]:
            x = (x << bits | (v & ((1 << bits) - 1))) & MASK
        packed.append(signed(x))
    return packed


@pytest.mark.parametrize(("bins", "bits"), [(256, 4), (64, 8), (128, 1)])
def test_matches_a_plain_version(awkward, bins, bits):
    docs = awkward.where("length(text) < 4000 or text is null")
    rows = fp.with_fingerprint(docs, "text", "print", bins=bins, bits=bits).collect()
    for r in rows:
        assert r["print"] == by_hand(r.text, bins=bins, bits=bits)


def test_likeness_is_close_to_the_similarity(make_docs):
    base = words(400, 9).split()
    other = words(400, 10).split()
    rows = []
    for n in range(21):
        cut = 400 - 20 * n
        rows.append((n, " ".join(base[:cut] + other[cut:])))
    docs = make_docs(rows)
    prints = fp.with_fingerprint(docs, "text", "print").select("doc_id", "text", "print")
    first = prints.where("doc_id = 0").select(F.col("print").alias("first"))
    found = prints.crossJoin(F.broadcast(first)).select("doc_id", "text", fp.likeness(F.col("print"), F.col("first")).alias("x"))

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    a = shingles(rows[0][1])
    for r in found.collect():
        b = shingles(r.text)
        assert abs(r.x - len(a & b) / len(a | b)) < 0.13
        assert 0 <= r.x <= 1


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_next_document(awkward, buckets):
    rows = fp.with_next(awkward.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"], buckets).collect()
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(i, t or "", order[(n + 1) % len(order)][1] or "") for n, (i, t) in enumerate(order)]
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in rows) == sorted((str(i), t, x) for i, t, x in want)


def test_edited_text(make_docs):
    docs = make_docs([(1, "abcde"), (2, "xy"), (3, None), (4, "é漢字!")])
    rows = {r.doc_id: r for r in fp.edited_fingerprints(docs).collect()}
    assert [rows[i].edited_text for i in (1, 2, 3, 4)] == ["abcxy", "x", "", "é漢ab"]
    assert [rows[i].n_chars for i in (1, 2, 3, 4)] == [5, 2, 0, 4]
    assert rows[3].fingerprint == [] and rows[3].near_edited == 1.0 and rows[3].near_next == 0.0


def test_one_row_and_none(make_docs, no_docs):
    only = fp.edited_fingerprints(make_docs([(7, "some few words that make up one document")])).collect()
    assert only[0].near_next == 1.0
    assert fp.edited_fingerprints(no_docs).count() == 0
