import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from demandcast.llm.exact_dedup import drop_exact_duplicates, exact_groups
from demandcast.llm.oracles import ORACLES
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF_DIR


def check_groups(rows):
    groups = defaultdict(list)
    for i, t in AWKWARD:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    assert len(rows) == len(AWKWARD)
    kept = defaultdict(int)
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept) == set(groups) and set(kept.values()) == {1}


@pytest.mark.parametrize("block_bytes", [64, 4096])
def test_groups_of_equal_texts(awkward, store, block_bytes):
    docs = awkward if block_bytes > 100 else awkward.where(F.length("text") < 3_000)
    if block_bytes > 100:
        check_groups(exact_groups(docs, store, block_bytes=block_bytes).collect())
    else:
        rows = exact_groups(docs, store, block_bytes=block_bytes).collect()
        texts = [r.text for r in docs.collect()]
        assert sorted(r.group_size for r in rows) == sorted(texts.count(t) for t in texts)


def test_colliding_digests_do_not_join_texts(awkward, store):
    docs = awkward
    check_groups(exact_groups(docs, store, digest=lambda b: F.pmod(F.crc32(b), F.lit(3))).collect())


def test_kept_rows_have_all_columns(awkward, store):
    kept = drop_exact_duplicates(awkward, store)
    assert kept.columns == awkward.columns
    assert kept.count() == len({t or "" for _, t in AWKWARD})


def test_empty_table(no_docs, store):
    assert exact_groups(no_docs, store).count() == 0
    assert drop_exact_duplicates(no_docs, store).count() == 0


def test_matches_sql(spark):
    ours = QUERIES["op1_exact_dedup"](spark, SF_DIR).toPandas()
    assert compare(ours, connect(SF_DIR).sql(ORACLES["op1_exact_dedup"]).df()) == ""
