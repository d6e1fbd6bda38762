import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandcast.llm import packing
from demandcast.llm.queries import QUERIES
from demandcast.llm.tokens import tokenizer_path
from tests.llm.conftest import AWKWARD, SF_DIR


def holds(found, demand, capacity):
    count = Counter()
    for parts, times in found:
        assert times >= 1 and sum(n * k for n, k in parts.items()) <= capacity
        for n, k in parts.items():
            count[n] += k * times
    return dict(count) == {n: k for n, k in demand.items() if k}


@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=25))
@settings(max_examples=60, deadline=None)
def test_plan_holds_exactly_the_demand(demand):
    found = packing.plan(demand, 60)
    assert holds(found, demand, 60)
    places, seen = packing.Places.of(found), defaultdict(list)
    for n, k in demand.items():
        if k:
            sequence, offset = places.find(np.full(k, n), np.arange(k))
            for s, o in zip(sequence.tolist(), offset.tolist()):
                seen[s].append((o, n))
    for parts in seen.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 60


def test_knapsack_against_all_sets():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(1, 20), 4, replace=False))
        weights = rng.random(4)
        best = 0.0

        def go(at, room, value):
            nonlocal best
            best = max(best, value)
            for n in range(at, 4):
                if lengths[n] <= room:
                    go(n, room - lengths[n], value + weights[n])

        go(0, 19, 0.0)
        found = packing.price(weights, lengths, 19)
        value = sum(k * weights[lengths.tolist().index(n)] for n, k in found.items())
        assert value == pytest.approx(best) and sum(n * k for n, k in found.items()) <= 19


@pytest.mark.parametrize("seed", [0, 1])
def test_close_to_the_lower_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5, 1, 20_000).astype(int) + 1, 512)
    demand = dict(Counter(lengths.tolist()))
    found = packing.plan(demand, 512)
    assert holds(found, demand, 512)
    assert sum(t for _, t in found) <= 1.005 * math.ceil(lengths.sum() / 512) + 1


def check(rows, docs, capacity=2048):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
    encode.encode_special_tokens = True
    want = []
    for i, t in docs:
        ids = [*encode.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at : at + capacity], dtype="<u4")
            want.append((str(i), n, at, len(own), zlib.crc32(own.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_awkward_rows(awkward, store, capacity):
    check(packing.pack_documents(awkward, store, capacity=capacity).collect(), AWKWARD, capacity)


def test_empty_table(no_docs, store):
    assert packing.pack_documents(no_docs, store).count() == 0


def test_query(spark):
    rows = QUERIES["op9_packing"](spark, SF_DIR).collect()
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    used = check(rows, docs)
    assert used <= 1.03 * math.ceil(sum(r.length for r in rows) / 2048) + 1


def piecewise_best_fit(demand, capacity):
    rooms = []
    for n in sorted(demand, reverse=True):
        for _ in range(demand[n]):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - n)
    return len(rooms)


@pytest.mark.parametrize(("demand", "fewest"), [
    ({512: 400, 1536: 100}, 175),
    ({683: 300, 682: 300, 1024: 200}, 301),
    ({900: 600, 574: 1200}, 600),
    ({1025: 100, 600: 200, 423: 100}, 150),
])
def test_few_lengths_against_the_bound(demand, fewest):
    found = packing.plan(demand, 2048)
    _, bound = packing.solve_program(demand, 2048)
    used = sum(t for _, t in found)
    assert holds(found, demand, 2048)
    assert used <= piecewise_best_fit(demand, 2048)
    assert bound - 1e-6 <= used <= math.ceil((1 + packing.GAP) * bound) + len(demand)
    assert used <= fewest + len(demand)


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=12))
@settings(max_examples=60, deadline=None)
def test_best_fit_piece_by_piece(demand):
    found = packing.best_fit(demand, 60)
    assert holds(found, demand, 60) and sum(t for _, t in found) == piecewise_best_fit(demand, 60)


def test_the_program_ends_within_its_gap():
    rng = np.random.default_rng(5)
    demand = dict(Counter((rng.integers(120, 300, 5_000)).tolist()))
    found, bound = packing.solve_program(demand, 512)
    covered = Counter()
    for parts, times in found:
        assert sum(n * k for n, k in parts.items()) <= 512
        for n, k in parts.items():
            covered[n] += k * times
    assert all(covered[n] >= k - 1e-6 for n, k in demand.items())
    assert sum(t for _, t in found) <= (1 + packing.GAP) * bound * (1 + 1e-9)
