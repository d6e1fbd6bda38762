import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig, TreeParams
from demandcast.operators.recursion import rolling_mean
from demandcast.plans.forecast import forecast, run_and_publish
from demandcast.sources.history import FORECAST_SCHEMA
from demandcast.sources.storage import Storage
from tests.conftest import SALES, monday

CFG = ForecastConfig(trees=TreeParams(n_trees=2, max_depth=3, max_bins=16))
KEYS = ["chain_id", "store_id", "product_id"]


@pytest.fixture(scope="module")
def sales(spark):
    random.seed(8)
    rows = [
        (c, s, p, monday(i) + timedelta(days=random.randint(0, 6)), float(random.randint(1, 9)))
        for c in (1, 2) for s in (c * 10, c * 10 + 1) for p in range(3) for i in range(115)
        if random.random() < 0.7 and (c == 1 or i > 80)
    ]
    rows += [(3, 30, 1, monday(112), 5.0)]  # too little history
    return spark.createDataFrame(rows, SALES).cache()


def test_online_forecast(spark, sales):
    as_of = monday(115)
    out = forecast(sales, as_of.isoformat(), CFG, rule=rolling_mean)
    rows = out.collect()
    assert [f.name for f in out.schema] == FORECAST_SCHEMA.names
    assert [str(f.dataType) for f in out.schema] == [str(f.dataType) for f in FORECAST_SCHEMA]
    assert {r.week_start for r in rows} == {as_of + timedelta(weeks=i) for i in range(4)}
    assert {r.chain_id for r in rows} == {1, 2} and len(rows) == 12 * 4
    assert all(r.forecast >= 0 and r.actual == 0 for r in rows)
    assert rows == sorted(rows, key=lambda r: (r.week_start, r.chain_id, r.store_id, r.product_id))


def test_batch_forecast_changes_only_future_weeks(sales):
    out = forecast(sales, monday(106), CFG, online=False, window_end=date(2004, 1, 1), rule=rolling_mean).collect()
    last = sales.where("qty > 0").agg(F.max("sale_date")).first()[0]
    past = [r for r in out if r.week_start <= last]
    assert past and all(r.forecast == round(r.pred_model) for r in past)
    assert max(r.week_start for r in out) <= last + timedelta(weeks=4)
    assert any(r.actual > 0 for r in past)


def test_later_sales_do_not_change_an_earlier_forecast(sales):
    as_of = monday(100)
    known = sales.where(F.col("sale_date") < F.lit(as_of))
    tail = sales.where(F.col("sale_date") >= F.lit(as_of)).withColumn("qty", F.col("qty") * 100)
    a = forecast(sales, as_of, CFG, rule=rolling_mean).select(*KEYS, "week_start", "pred_model", "pred_base")
    b = forecast(known.unionByName(tail), as_of, CFG, rule=rolling_mean).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nothing_to_forecast(spark, sales):
    none = spark.createDataFrame([], SALES)
    assert forecast(none, monday(10), CFG, rule=rolling_mean).schema == FORECAST_SCHEMA
    assert forecast(sales, monday(2), CFG, rule=rolling_mean).count() == 0  # no chain has enough history
    short = sales.where("chain_id = 3")
    assert forecast(short, monday(115), CFG, rule=rolling_mean).count() == 0


def test_trees_and_publish(spark, sales, tmp_path):
    target = str(tmp_path / "target")
    storage = Storage(spark)
    models = str(tmp_path / "models")
    up = run_and_publish(sales, monday(115), target, 7, CFG, storage=storage, model_folder=models)
    assert up.count() == 48 and (tmp_path / "models").exists()
    run_and_publish(sales, monday(115), target, 8, CFG, rule=rolling_mean)
    run_and_publish(sales, monday(115), target, 8, CFG, rule=rolling_mean)
    stored = spark.read.parquet(target)
    assert {(r.algo_id, r["count"]) for r in stored.groupBy("algo_id").count().collect()} == {(7, 48), (8, 48)}
    assert stored.agg(F.min("date_key")).first()[0] == int(monday(115).strftime("%Y%m%d"))
    storage.drop()
    with pytest.raises(Exception, match="(?i)exist|found"):
        spark.read.parquet(f"{storage.folder}/weekly").count()
