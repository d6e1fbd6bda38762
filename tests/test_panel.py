from datetime import date, timedelta

from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.functions.calendar import align_sunday, months_before, week_start
from demandcast.functions.numeric import safe_div, shrink_and_clip
from demandcast.operators import panel
from demandcast.operators.joins import lookup_join
from demandcast.operators.seasonality import covered_months
from demandcast.plans.forecast import forecast_weeks
from tests.conftest import SALES, monday


def values(frame):
    return sorted(map(tuple, frame.collect()))


def test_weeks_start_on_monday(spark):
    days = spark.createDataFrame([(date(2025, 9, 7),), (date(2025, 9, 8),)], "d date")
    assert [r[0] for r in days.select(week_start(F.col("d"))).collect()] == [date(2025, 9, 1), date(2025, 9, 8)]


def test_weekly_totals_and_last_actual(spark):
    sales = spark.createDataFrame(
        [
            (1, 1, 1, date(2025, 9, 7), 2.0),
            (1, 1, 1, date(2025, 9, 8), 3.0),
            (1, 1, 1, date(2025, 9, 9), 0.0),
        ],
        SALES,
    )
    assert [r[3:] for r in values(panel.weekly_totals(sales))] == [(date(2025, 9, 1), 2.0), (date(2025, 9, 8), 3.0)]
    assert tuple(panel.last_actual(sales, 4).first()) == (date(2025, 9, 8), date(2025, 10, 6))
    nothing = panel.last_actual(sales.where(F.col("qty") < 0)).first()
    assert nothing["last_actual"] is None


def test_alignment_to_sunday(spark):
    frame = spark.range(1).select(
        align_sunday(F.lit(date(2025, 9, 1)), True),
        align_sunday(F.lit(date(2025, 9, 7)), True),
        align_sunday(F.lit(date(2025, 9, 7)), False),
        align_sunday(F.lit(date(2025, 9, 10)), False),
    )
    assert tuple(frame.first()) == (date(2025, 9, 7),) * 4


def test_forecast_windows():
    cfg = ForecastConfig()
    online = forecast_weeks(date(2025, 9, 10), None, cfg, True, None)
    assert online == [date(2025, 9, 8) + timedelta(weeks=i) for i in range(4)]
    batch = forecast_weeks(date(2025, 9, 1), date(2026, 6, 1), cfg, False, date(2025, 12, 31))
    assert len(batch) == 17 and batch[0] == date(2025, 9, 8) and batch[-1] == date(2025, 12, 29)
    capped = forecast_weeks(date(2025, 9, 1), date(2025, 9, 21), cfg, False, date(2025, 12, 31))
    assert capped[-1] == date(2025, 10, 13)


def test_chain_gates(weekly):
    as_of = monday(60)
    rows = weekly(
        {
            (7, 1, 1): {monday(i): 1 for i in range(7)},
            (8, 1, 1): {monday(i): 1 for i in range(8)},
            (8, 1, 2): {monday(i): 1 for i in range(8)},
            (9, 1, 1): {monday(60 + i): 1 for i in range(20)},
        }
    )
    chains = panel.eligible_chains(rows, as_of, 8)
    assert values(chains) == [(8, 8)]
    assert {r.chain_id for r in panel.keep_chains(rows, chains).collect()} == {8}
    assert {r.chain_id for r in panel.keep_chains(rows, chains, max_chains=3).collect()} == {8}


def test_yoy_needs_365_days(weekly):
    as_of = date(2001, 1, 1)
    rows = weekly({(1, 1, 1): {as_of - timedelta(days=364): 1}, (2, 1, 1): {as_of - timedelta(days=371): 1}})
    flags = {r.chain_id: r.use_yoy for r in panel.yoy_eligible(rows, as_of).collect()}
    assert flags == {1: False, 2: True}
    exact = {r.chain_id: r.use_yoy for r in panel.yoy_eligible(rows, as_of + timedelta(days=1)).collect()}
    assert exact[1] is True


def test_dense_panel_fills_every_week(weekly):
    rows = weekly({(1, 1, 1): {monday(0): 5, monday(3): 6}, (1, 1, 2): {monday(2): 1}, (1, 1, 3): {monday(9): 1}})
    grid = panel.dense_panel(rows, monday(4) + timedelta(days=3))
    assert grid.count() == 2 * 5
    first = [(r.weekly_total, r.has_actual) for r in grid.where("product_id = 1").orderBy("week_start").collect()]
    assert first == [(5.0, True), (None, False), (None, False), (6.0, True), (None, False)]
    second = [r.weekly_total for r in grid.where("product_id = 2").orderBy("week_start").collect()]
    assert second == [None, None, 1.0, None, None]


def test_density_counts_empty_weeks(weekly):
    rows = weekly({(1, 1, 1): {monday(i): 10 for i in range(3)}, (1, 1, 2): {monday(9): 100}})
    out = {r.product_id: r for r in panel.sku_density(rows, monday(10), monday(0)).collect()}
    assert out[1].avg_weekly == 3.0 and abs(out[1].zero_rate - 0.7) < 1e-12 and out[1].is_dense
    assert out[2].avg_weekly == 10.0 and not out[2].is_dense


def test_last_rows_and_merge(weekly, forecast_rows):
    rows = weekly({(1, 1, 1): {monday(i): i for i in range(5)}})
    assert [r.week_start for r in panel.last_k_per_sku(rows, 2).orderBy("recency").collect()] == [monday(4), monday(3)]
    grid = panel.dense_panel(rows, monday(5))
    new = rows.withColumn("prediction", F.lit(9.0))
    merged = panel.merge_update(grid, new, monday(3)).orderBy("week_start").collect()
    assert [r.sim_sales for r in merged] == [0.0, 1.0, 2.0, 9.0, 9.0, None]


def test_salted_join_equals_broadcast_join(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).cast("long").alias("chain_id"),
        F.col("id").alias("store_id"),
        F.lit(1).alias("product_id"),
    )
    lookup = spark.createDataFrame([(i, i * 10) for i in range(5)], "chain_id long, v long")
    for how in ("left", "left_semi", "left_anti", "inner"):
        salted = lookup_join(rows, lookup, ["chain_id"], ["store_id"], how=how)
        plain = lookup_join(rows, lookup, ["chain_id"], ["store_id"], how=how, max_rows=5)
        assert salted.count() == plain.count()
        assert salted.exceptAll(plain.select(*salted.columns)).count() == 0


def test_helpers(spark):
    one = spark.range(1).select(
        safe_div(F.lit(1.0), F.lit(0.0)),
        safe_div(F.lit(1.0), F.lit(None).cast("double"), 5.0),
        safe_div(F.lit(1.0), F.lit(4.0)),
        shrink_and_clip(F.lit(3.0), 0.5, 0.8, 1.2),
        shrink_and_clip(F.lit(1.2), 0.5, 0.8, 1.2),
        shrink_and_clip(F.lit(0.0), 0.5, 0.8, 1.2),
        shrink_and_clip(F.lit(float("inf")), 0.5, 0.8, 1.2),
    )
    assert [round(v, 9) for v in one.first()] == [0.0, 5.0, 0.25, 1.2, 1.1, 1.0, 1.0]


def test_month_arithmetic():
    assert months_before(date(2025, 8, 31), 18) == date(2024, 2, 29)
    assert months_before(date(2025, 1, 15), 1) == date(2024, 12, 15)
    assert covered_months(date(2025, 1, 6), date(2025, 4, 1), 24) == [1, 2, 3]
