from collections import Counter

import pytest

from demandcast.llm import sharding
from tests.llm.conftest import AWKWARD

NAMES = [f"s{n}" for n in range(7)]


def test_table_is_full_and_even():
    table = sharding.lookup_table(NAMES, 1009)
    share = Counter(table)
    assert set(table) == set(range(7)) and max(share.values()) - min(share.values()) <= 1


def test_turns_by_hand():
    table = sharding.lookup_table(["a", "b", "c"], 13)
    free = set(range(13))
    order = {
        s: [(sharding._hash(f"offset {s}") % 13 + j * (sharding._hash(f"skip {s}") % 12 + 1)) % 13 for j in range(13)] for s in "abc"
    }
    while free:
        for n, s in enumerate("abc"):
            if free:
                slot = next(x for x in order[s] if x in free)
                assert table[slot] == n
                free.remove(slot)


def test_weights_take_turns():
    share = Counter(sharding.lookup_table(NAMES, 1009, [1, 1, 1, 1, 1, 1, 3]))
    assert abs(share[6] / 1009 - 1 / 3) < 0.01


def test_a_shard_less_moves_little():
    before = sharding.lookup_table(NAMES, 10_007)
    after = sharding.lookup_table(NAMES[:-1], 10_007)
    moved = sum(a != b for a, b in zip(after, before) if b != 6)
    assert moved < 0.1 * 10_007


@pytest.mark.parametrize("bad", [([], 13, None), (["a", "a"], 13, None), (["a"], 12, None), (["a", "b"], 2, None), (["a"], 13, [0])])
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        sharding.lookup_table(*bad)


def test_rows_of_one_key_share_a_shard(awkward, no_docs):
    rows = sharding.assign_shards(awkward, NAMES, 1009).collect()
    table = sharding.lookup_table(NAMES, 1009)
    assert len(rows) == len(AWKWARD)
    assert all(table[r.slot] == r.shard for r in rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({i for i, _ in AWKWARD})
    assert sharding.assign_shards(no_docs, NAMES, 1009).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(awkward, NAMES, 1009, slot="row")


def test_written_shards(spark, awkward, tmp_path):
    sharding.write_shards(awkward, str(tmp_path / "out"), NAMES, per_file=2, size=1009)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(AWKWARD)


def test_plan_has_no_shuffle_and_no_python(awkward):
    plan = sharding.assign_shards(awkward, NAMES, 1009)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan and "Python" not in plan
