import pytest

from demandcast.llm import exact_dedup, mixing, simhash
from demandcast.llm.common import with_stable_row_id

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.mark.parametrize("stage", ["exact", "near", "mix"])
def test_splits_may_change_between_two_scans(spark, make_docs, store, monkeypatch, stage):
    docs = make_docs([(n, f"text {n % 20} of number {n % 20} in a line") for n in range(60)])
    module, name = {"exact": (exact_dedup, "exact_groups"), "near": (simhash, "near_groups"), "mix": (mixing, "take_shares")}[stage]
    first = getattr(module, name)

    def then_in_one_split(*args, **options):
        found = store.table(f"first_{stage}", first(*args, **options))
        spark.conf.set(SPLITS, "1")
        return found

    monkeypatch.setattr(module, name, then_in_one_split)
    try:
        if stage == "exact":
            rows = exact_dedup.drop_exact_duplicates(docs, store).collect()
            assert sorted(r.doc_id for r in rows) == list(range(40, 60))
        elif stage == "near":
            rows = simhash.drop_near_duplicates(docs, store, radius=0).collect()
            assert sorted(r.doc_id for r in rows) == list(range(20))
        else:
            weights = spark.createDataFrame([("s0", 1), ("s1", 1), ("s2", 1), (None, 1)], "source string, weight int")
            rows = sorted(r.doc_id for r in mixing.mix_sources(docs, weights, store, 0.3).collect())
            taken = spark.read.parquet(f"{store.folder}/first_mix").where("times > 0").collect()
            assert rows == sorted(r.doc_id for r in taken for _ in range(r.times)) and rows
    finally:
        spark.conf.unset(SPLITS)


def test_rows_that_are_no_scan_are_stored(spark, make_docs, store):
    docs = make_docs([(n, f"text {n}") for n in range(10)])
    for rows in (docs.unionByName(docs), docs.where("doc_id > 3"), docs.limit(5)):
        found = with_stable_row_id(rows, "number", store)
        assert found.select("number").distinct().count() == rows.count() and found.columns == [*rows.columns, "number"]
