import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig, TreeParams
from demandcast.operators import features as feat
from demandcast.operators import model as trees
from demandcast.operators.seasonality import chain_index, sku_profiles
from demandcast.sources.sinks import load_model, save_model
from tests.conftest import monday

CFG = ForecastConfig(trees=TreeParams(n_trees=3, max_depth=3, max_bins=16))
KEYS = ["chain_id", "store_id", "product_id"]


@pytest.fixture(scope="module")
def setup(spark):
    random.seed(4)
    rows = [
        (c, s, p, monday(i), float(random.randint(0, 8) + 6 * p))
        for c in (1, 2) for s in (c * 10,) for p in range(4) for i in range(110)
        if random.random() < 0.8
    ]
    schema = "chain_id long, store_id long, product_id long, week_start date, weekly_total double"
    weekly = spark.createDataFrame(rows, schema).cache()
    inputs = trees.sku_inputs(weekly, sku_profiles(weekly, monday(100), monday(0), CFG)).cache()
    frame = trees.feature_frame(weekly, monday(0), inputs, CFG).cache()
    return weekly, inputs, frame


def test_feature_frame_is_complete(setup):
    weekly, inputs, frame = setup
    assert frame.count() == weekly.count()
    assert set(feat.FEATURES) <= set(frame.columns) and len(feat.FEATURES) == 32
    assert inputs.count() == weekly.select(*KEYS).distinct().count()


def test_training_rows_need_every_feature_but_last_years_lag(setup):
    frame = setup[2]
    kept = trees.train_rows(frame)
    assert kept.where("lag_1w IS NULL OR lag_3w IS NULL OR roll12w IS NULL").count() == 0
    assert kept.where("lag_52w IS NULL").count() > 0
    broken = frame.withColumn("weekly_total", F.when(F.col("store_id") == 10, float("nan")).otherwise(F.lit(-1.0)))
    assert trees.train_rows(broken).count() == 0


def test_weights_halve_as_lambda_says(spark):
    row = spark.createDataFrame(
        [(monday(0), 5.0, 5.0), (monday(0), 201.0, 5.0), (monday(0), 5.0, 201.0), (monday(20), 5.0, 5.0)],
        "week_start date, avg_nonzero_12w double, roll12w double",
    )
    got = [r[0] for r in row.select(trees.recency_weight(monday(10), 0.03)).collect()]
    slow, fast = 2.718281828459045 ** (-0.3), 2.718281828459045 ** (-0.45)
    assert got == pytest.approx([slow, fast, fast, 1.0])


def test_model_beats_the_zero_forecast_and_survives_storage(setup, tmp_path):
    frame = setup[2]
    model = trees.train_for_cutoff(frame, monday(100), 0.03, CFG)
    out = trees.predict(model, frame.where(F.col("week_start") >= F.lit(monday(100))))
    error, sold = out.agg(F.sum(F.abs(F.col("pred_model") - F.col("weekly_total"))), F.sum("weekly_total")).first()
    assert error / sold < 0.6
    assert out.where("pred_model < 0").count() == 0
    save_model(model, str(tmp_path), monday(100))
    again = trees.predict(load_model(str(tmp_path), monday(100)), frame.limit(50))
    assert again.exceptAll(trees.predict(model, frame.limit(50)).select(*again.columns)).count() == 0


def test_rows_without_features_are_predicted_zero(setup):
    frame = setup[2]
    model = trees.train_for_cutoff(frame, monday(100), 0.03, CFG)
    holes = frame.limit(20).withColumn("roll3w", F.lit(None).cast("double"))
    assert {r.pred_model for r in trees.predict(model, holes).collect()} == {0.0}


def test_too_few_rows_give_no_model_and_the_default_lambda(setup):
    few = setup[2].limit(150)
    assert trees.fit_trees(few, monday(100), 0.03, CFG) is None
    assert trees.tune_lambda(few, monday(100), CFG) == CFG.recency_default


@pytest.mark.parametrize("holdout", [False, True])
def test_lambda_is_one_of_the_biased_candidates(setup, holdout):
    frame = setup[2]
    scores = {r.lam: r.wape for r in trees.lambda_scores(frame, monday(100), CFG, holdout).collect()}
    assert set(scores) == set(CFG.recency_candidates) and all(0 < v < 1 for v in scores.values())
    best = min(scores, key=lambda k: (scores[k], k))
    assert trees.tune_lambda(frame, monday(100), CFG, holdout) == pytest.approx(min(best * 1.2, 0.08))


def test_model_month_is_that_of_the_sunday_before():
    assert trees.model_month(monday(0)).isoformat() == "2000-01-01"
    first_of_may = monday(17)
    assert first_of_may.isoformat() == "2000-05-01" and trees.model_month(first_of_may).isoformat() == "2000-04-01"


def test_profile_fallbacks(spark, weekly):
    # chain 1: long history; chain 2: 10 weeks only, so its index gives way to the global one
    rows = weekly(
        {
            (1, 1, 1): {monday(i): 5 + (i % 52 > 40) * 20 for i in range(104)},
            (2, 2, 1): {monday(i): 50 for i in range(94, 104)},
            (2, 2, 9): {monday(110): 1},
        }
    )
    as_of = monday(104)
    out = {(r.chain_id, r.product_id): r for r in sku_profiles(rows, as_of, monday(0)).collect()}
    chain = {(r.chain_id, r.month): r.szn_index for r in chain_index(rows, as_of, monday(0)).collect()}
    last = (as_of - timedelta(days=7)).month
    assert out[(1, 1)].chain_szn[last - 1] == chain[(1, last)]
    assert out[(2, 1)].chain_szn != out[(1, 1)].chain_szn
    assert out[(2, 1)].chain_szn[last - 1] != chain[(2, last)]
    assert out[(2, 9)].sku_szn == [1.0] * 12  # sold nothing in the lookback
    assert out[(2, 9)].product_szn == [1.0] * 4
