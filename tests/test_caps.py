import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators import caps
from demandcast.operators.seasonality import season_direction
from tests.conftest import monday

KEYS = ["chain_id", "store_id", "product_id"]
WEEK = date(2001, 6, 4)


def flags(spark, **use):
    return spark.createDataFrame([(int(k[1:]), v) for k, v in use.items()], "chain_id long, use_yoy boolean")


def row(chain, product, forecast, actual=0.0, week=WEEK):
    return (chain, 1, product, week, actual, forecast, forecast, forecast)


def forecasts(frame):
    return {(r.chain_id, r.product_id, r.week_start): r.forecast for r in frame.collect()}


def test_sku_tiers(spark, weekly, forecast_rows):
    sizes = [19, 20, 99, 100, 999, 1000]
    last_year = weekly({(1, 1, p): {WEEK - timedelta(days=364): v} for p, v in enumerate(sizes)})
    rows = forecast_rows([row(1, p, 1e6) for p in range(6)] + [row(1, 6, 1e6), row(2, 0, 1e6)])
    out = forecasts(caps.cap_sku_yoy(rows, last_year, flags(spark, c1=True, c2=False)))
    got = [out[(1, p, WEEK)] for p in range(6)]
    assert got == [19 * 2.5, 20 * 2.0, 99 * 2.0, 100 * 1.5, 999 * 1.5, 1000 * 1.2]
    assert out[(1, 6, WEEK)] == 1e6 and out[(2, 0, WEEK)] == 1e6


def test_chain_week_cap_cases(spark, weekly, forecast_rows):
    before = WEEK - timedelta(days=364)
    last_year = weekly({(1, 1, 1): {before: 10}, (2, 1, 1): {before: 0}, (4, 1, 1): {before: 10}, (5, 1, 1): {before: 10}})
    rows = forecast_rows(
        [row(1, 1, 30.0), row(1, 2, 10.0), row(2, 1, 30.0), row(3, 1, 30.0), row(4, 1, 30.0), row(5, 1, 0.0)]
    )
    use = flags(spark, c1=True, c2=True, c3=True, c4=False, c5=True)
    out = forecasts(caps.cap_chain_week(rows, last_year, use))
    assert out[(1, 1, WEEK)] == pytest.approx(15) and out[(1, 2, WEEK)] == pytest.approx(5)
    assert out[(2, 1, WEEK)] == out[(3, 1, WEEK)] == out[(4, 1, WEEK)] == 30.0 and out[(5, 1, WEEK)] == 0.0
    again = caps.cap_chain_week(rows, last_year, use, max_groups=10)
    assert forecasts(again) == out


def test_month_cap_uses_last_year(spark, weekly, forecast_rows):
    known = weekly({(1, 1, 1): {date(2000, 6, 5): 10}})
    rows = forecast_rows([row(1, 1, 20.0), row(1, 2, 20.0)])
    out = forecasts(caps.cap_chain_month(rows, known, flags(spark, c1=True)))
    assert sum(out.values()) == pytest.approx(16.0)


@pytest.mark.parametrize(
    ("volume", "low", "high"),
    [(19, 0.6, 1.5), (20, 0.7, 1.35), (99, 0.7, 1.35), (100, 0.8, 1.25), (499, 0.8, 1.25), (500, 0.9, 1.15)],
)
def test_month_bounds_by_volume(spark, weekly, forecast_rows, volume, low, high):
    known = weekly({(1, 1, 1): {date(2001, 5, 7): volume}})
    for size, expected in ((1e6, high * volume), (0.01, low * volume)):
        out = forecasts(caps.cap_chain_month(forecast_rows([row(1, 1, size)]), known, flags(spark, c1=False)))
        assert out[(1, 1, WEEK)] == pytest.approx(expected)
    kept = caps.cap_chain_month(forecast_rows([row(1, 1, 0.01)]), known, flags(spark, c1=False), floor=False)
    assert forecasts(kept)[(1, 1, WEEK)] == pytest.approx(0.01)


def test_month_base_falls_back_to_past_forecasts_then_to_itself(spark, weekly, forecast_rows):
    nothing = weekly({(9, 1, 1): {date(2001, 5, 7): 1}})
    history = forecast_rows([row(1, 1, 40.0, week=date(2001, 4, 2)), row(1, 1, 60.0, week=date(2001, 5, 7)),
                             row(1, 1, 999.0, week=date(2001, 6, 4))])
    rows = forecast_rows([row(1, 1, 1000.0), row(2, 1, 1000.0)])
    out = forecasts(caps.cap_chain_month(rows, nothing, flags(spark, c1=True, c2=True), history=history))
    assert out[(1, 1, WEEK)] == pytest.approx(50 * 1.35)
    assert out[(2, 1, WEEK)] == pytest.approx(1000.0)


def test_recent_base_takes_six_months_strictly_before(spark, weekly):
    months = [date(2000, m, 7) for m in range(1, 10)]
    known = weekly({(1, 1, 1): {d - timedelta(days=d.weekday()): 10.0 * (i + 1) for i, d in enumerate(months)}})
    points = spark.createDataFrame([(1, date(2000, m, 1)) for m in (1, 3, 9)], "chain_id long, month_start date")
    from demandcast.operators.panel import chain_month_totals

    out = {r.month_start.month: r.recent_base for r in caps.recent_actuals_base(points, chain_month_totals(known)).collect()}
    assert out == {1: None, 3: 15.0, 9: 55.0}


def test_trend_with_short_histories(spark, weekly):
    facts = {1: [1, 1, 1], 2: [10, 10, 10, 10], 3: [10, 10, 10, 10, 12], 4: [10] * 4 + [11] * 4, 5: [10] * 4 + [90] * 4}
    first = date(2001, 1, 1)
    rows = weekly({(c, 1, 1): {first + timedelta(weeks=i): v for i, v in enumerate(vs)} for c, vs in facts.items()})
    points = spark.createDataFrame([(c, date(2001, 6, 1)) for c in [*facts, 6]], "chain_id long, month_start date")
    from demandcast.operators.panel import chain_week_totals

    out = {r.chain_id: r.trend for r in caps.chain_trend(points, chain_week_totals(rows)).collect()}
    assert out[1] == out[6] == 1.0 and out[2] == pytest.approx(1.0)
    assert out[3] == pytest.approx(42 / 40, abs=1e-6) and out[4] == pytest.approx(1.1, abs=1e-6) and out[5] == 1.3


def test_direction_and_trend_shift_the_bounds(spark, weekly, forecast_rows):
    known = weekly({(1, 1, 1): {date(2001, 4, 2) + timedelta(weeks=i): v for i, v in enumerate([50] * 4 + [65] * 4)}})
    directions = spark.createDataFrame([(1, 3, 1)], "chain_id long, season int, direction int")
    out = caps.cap_chain_month(forecast_rows([row(1, 1, 1e6)]), known, flags(spark, c1=False), directions)
    april, may = 50 * 4 + 65, 65 * 3
    base = (april + may) / 2
    assert forecasts(out)[(1, 1, WEEK)] == pytest.approx(base * 1.25 * (1 + 0.3 * 0.3), rel=1e-6)


def test_season_direction(weekly):
    def summers(*totals):
        return {date(1998 + i, 6, 1) + timedelta(days=(7 - date(1998 + i, 6, 1).weekday()) % 7): t for i, t in enumerate(totals)}

    rows = weekly({(1, 1, 1): summers(100, 120), (2, 1, 1): summers(100, 103), (3, 1, 1): summers(100, 80), (4, 1, 1): summers(0, 5)})
    out = {r.chain_id: r.direction for r in season_direction(rows, date(1999, 9, 1), date(1998, 6, 1)).where("season = 3").collect()}
    assert out == {1: 1, 2: 0, 3: -1, 4: 1}
    # the last summer lies after the cutoff
    assert season_direction(rows, date(1999, 1, 4), date(1998, 6, 1)).where("season = 3").count() == 0


def test_reconcile_hits_target_and_keeps_locked_rows(spark, forecast_rows):
    rows = forecast_rows([row(1, 1, 10.0), row(1, 2, 30.0), row(1, 3, 5.0, actual=7.0), row(2, 1, 5.0, actual=1.0), row(3, 1, 0.0)])
    targets = spark.createDataFrame([(c, WEEK, 65.0) for c in (1, 2, 3)], "chain_id long, week_start date, target double")
    out = forecasts(caps.reconcile(rows, targets))
    assert [out[(1, p, WEEK)] for p in (1, 2, 3)] == [15.0, 45.0, 5.0]
    assert out[(2, 1, WEEK)] == 5.0 and out[(3, 1, WEEK)] == 0.0
    assert forecasts(caps.reconcile(rows)) == forecasts(rows)
    low = targets.withColumn("target", F.lit(4.0))
    assert forecasts(caps.reconcile(rows, low))[(1, 1, WEEK)] == 10.0


def test_smoothing_cases(forecast_rows):
    rows = forecast_rows(
        [row(1, 1, 10.0), row(1, 2, 30.0), row(1, 3, 99.0, actual=1.0)]
        + [row(2, 1, 10.0), row(2, 2, 30.0, actual=1.0)]  # one free row
        + [row(3, 1, 10.0, actual=1.0), row(3, 2, 30.0, actual=1.0)]  # all locked
        + [row(4, 1, 0.0), row(4, 2, 0.0)]  # nothing to distribute
    )
    out = forecasts(caps.smooth_month(rows))
    assert [out[(1, p, WEEK)] for p in (1, 2, 3)] == pytest.approx([11.5, 28.5, 99.0])
    assert [out[(2, 1, WEEK)], out[(2, 2, WEEK)], out[(3, 1, WEEK)], out[(4, 1, WEEK)]] == [10.0, 30.0, 10.0, 0.0]
    by_sku = forecasts(caps.smooth_month(rows, keys=KEYS))
    assert by_sku[(1, 1, WEEK)] == 10.0


def test_caps_without_floor_never_raise_and_smoothing_keeps_totals(spark, weekly, forecast_rows):
    random.seed(2)
    weeks = [monday(60 + i) for i in range(6)]
    known = weekly({(c, 1, p): {monday(i): random.randint(0, 30) for i in range(60)} for c in (1, 2) for p in range(4)})
    rows = forecast_rows([row(c, p, random.random() * 60, 0.0, w) for c in (1, 2) for p in range(4) for w in weeks])
    use = flags(spark, c1=True, c2=False)
    directions = season_direction(known, monday(60), monday(0))
    before = forecasts(rows)
    capped = caps.cap_chain_month(
        caps.cap_sku_yoy(caps.cap_chain_week(rows, known, use), known, use), known, use, directions,
        cfg=ForecastConfig(), floor=False,
    )
    after = forecasts(capped)
    assert all(after[k] <= before[k] + 1e-9 for k in before) and any(after[k] < before[k] for k in before)
    smooth = forecasts(caps.smooth_month(rows))
    for chain in (1, 2):
        for month in {w.month for w in weeks}:
            pick = lambda f: sum(v for (c, _, w), v in f.items() if c == chain and w.month == month)
            assert pick(smooth) == pytest.approx(pick(before))
