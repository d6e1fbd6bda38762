from datetime import date

import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators import metrics
from demandcast.plans.bias import update_bias
from tests.conftest import monday


def test_weighted_mape_and_wape(spark):
    rows = spark.createDataFrame([("a", 10.0, 8.0), ("a", 0.0, 5.0), ("b", 0.0, 1.0)], "g string, actual double, forecast double")
    assert {r.g: r.wmape for r in metrics.weighted_mape(rows, ["g"]).collect()} == {"a": 0.2, "b": float("inf")}
    assert {r.g: r.wape for r in metrics.wape(rows, ["g"]).collect()} == {"a": 0.7, "b": None}
    assert metrics.wape(rows).first()[0] == 0.8


@pytest.mark.parametrize(
    ("months", "expected"),
    [
        ([(10.0, 11.0)] * 6, (0.9, 1.1)),
        ([(10.0, 30.0)] * 6, (0.65, 1.35)),
        ([(10.0, 10.0)] * 6, (0.65, 1.35)),  # bounds would meet
        ([(0.0, 10.0)] * 6, (0.65, 1.35)),
        ([], (0.65, 1.35)),
        ([(1.0, 999.0), *[(10.0, 11.0)] * 6], (0.9, 1.1)),  # only the last six count
    ],
)
def test_fallback_bounds(spark, months, expected):
    rows = spark.createDataFrame([(monday(i), a, f) for i, (a, f) in enumerate(months)], "month_start date, actual double, forecast double")
    assert tuple(metrics.fallback_bounds(rows).first()) == pytest.approx(expected)


def chain_weeks(spark, weekly, chain_totals, ratio):
    panel = weekly({(c, 1, 1): {monday(i): t for i in range(110)} for c, t in chain_totals.items()})
    return panel, panel.withColumn("forecast", F.col("weekly_total") * ratio)


def test_bias_table_gates_and_clip(spark, weekly):
    panel, forecast = chain_weeks(spark, weekly, {1: 100, 4: 100, 5: 1}, 0.5)
    out = metrics.bias_table(panel, forecast).collect()
    assert {r.chain_id for r in out} == {4} and len(out) == 12
    assert all(r.bias_factor == pytest.approx(1.10) for r in out)  # 1 + 0.25 * (2 - 1), clipped
    assert metrics.bias_table(panel, forecast, min_weeks=111).count() == 0
    assert metrics.bias_table(panel, forecast, ForecastConfig(bias_excluded_chains=(4,))).count() == 12


def test_perfect_forecast_needs_no_bias(spark, weekly):
    panel, forecast = chain_weeks(spark, weekly, {4: 100}, 1.0)
    assert metrics.bias_table(panel, forecast).count() == 0


def test_alpha_must_beat_the_best_by_the_margin(spark):
    errors = lambda *e: spark.createDataFrame(list(zip([0.0, 0.05, 0.1, 0.15], e)), "alpha double, wmape double")
    assert metrics.select_alpha(errors(1.0, 0.99, 0.985, 0.5)).first().best_alpha == 0.15
    assert metrics.select_alpha(errors(1.0, 0.9, 0.89, 0.885)).first().best_alpha == 0.05
    assert metrics.select_alpha(errors(1.0, 0.99, 0.985, 0.981)).first().best_alpha is None


def test_update_bias_writes_only_if_it_helps(spark, tmp_path):
    sales = spark.createDataFrame(
        [(4, 1, p, monday(i), 50.0) for i in range(110) for p in (1, 2)],
        "chain_id long, store_id long, product_id long, sale_date date, qty double",
    )
    forecasts = sales.selectExpr("chain_id", "store_id", "product_id", "sale_date AS week_start", "qty * 1.25 AS forecast")
    table, log = str(tmp_path / "bias"), str(tmp_path / "log")
    right = forecasts.withColumn("forecast", F.col("forecast") / 1.25)
    assert not update_bias(sales, right, date(2025, 9, 1), table, log)
    assert update_bias(sales, forecasts, date(2025, 9, 1), table, log)
    assert update_bias(sales, forecasts, date(2025, 9, 8), table, log)
    factors = [r.bias_factor for r in spark.read.parquet(table).collect()]
    assert factors == pytest.approx([1 + 0.25 * (0.8 - 1)] * 12)
    assert spark.read.parquet(log).count() == 24
