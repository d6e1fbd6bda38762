import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators import adjust
from tests.conftest import monday

KEYS = ["chain_id", "store_id", "product_id"]


def series(product, actuals, model=0.0, base=0.0, future=3):
    """History weeks with the actuals given, then future weeks with forecast 10."""
    n = len(actuals)
    rows = [(1, 1, product, monday(i), float(a), model, base, model) for i, a in enumerate(actuals)]
    return rows + [(1, 1, product, monday(n + i), 0.0, 10.0, 20.0, 10.0) for i in range(future)]


def future_of(frame, last):
    return [r.forecast for r in frame.where(F.col("week_start") > F.lit(last)).orderBy(*KEYS, "week_start").collect()]


def test_smoothed_residuals_equal_pandas(spark):
    fitted = spark.createDataFrame(
        [(1, 1, 1, monday(i), r, 0.0) for i, r in enumerate([1.0, 2.0, 4.0, 8.0])],
        "chain_id long, store_id long, product_id long, week_start date, weekly_total double, y_hat double",
    )
    out = adjust.smoothed_residuals(fitted).orderBy("week_start").toPandas().resid_ewma
    expected = pd.Series([1.0, 2.0, 4.0, 8.0]).ewm(span=8, min_periods=3).mean()
    pd.testing.assert_series_equal(out, expected, check_names=False)


def test_residual_state_equals_the_last_running_value(forecast_rows):
    random.seed(1)
    rows = [r for p in range(4) for r in series(p, [random.randint(0, 9) for _ in range(p * 5 + 2)], 3.0, future=0)]
    last = monday(18)
    history = forecast_rows([r for r in rows if r[3] <= last])
    state = adjust.residual_state(history, last).toPandas().set_index("product_id")
    running = adjust.smoothed_residuals(history.selectExpr(*KEYS, "week_start", "actual weekly_total", "forecast y_hat"))
    scores = adjust.confidence_scores(history, "actual")
    for name, frame in (("resid_ewma", running), ("confidence", scores)):
        lasts = frame.toPandas().sort_values("week_start").groupby("product_id").tail(1).set_index("product_id")
        pd.testing.assert_series_equal(state[name].sort_index(), lasts[name].sort_index())
    assert state.loc[0].isna().resid_ewma and not state.loc[1].isna().resid_ewma


def test_weights_and_fallback(forecast_rows):
    last = monday(9)
    rows = forecast_rows(
        series(1, [5] * 10, model=5.0, base=9.0)  # model perfect: weight at its upper bound
        + series(2, [5] * 10, model=9.0, base=5.0)
        + series(3, [5] * 10, model=6.0, base=6.0)
        + [r for r in series(4, [0] * 10)]  # no observed week
    )
    weights = {r.product_id: r.w_model for r in adjust.ensemble_weights(rows, last).collect()}
    assert weights[1] == 0.9 and weights[2] == 0.1 and weights[3] == pytest.approx(0.5) and 4 not in weights
    blended = future_of(adjust.ensemble_blend(rows, last), last)
    assert blended[0] == pytest.approx(0.9 * 10 + 0.1 * 20)
    assert blended[9] == pytest.approx(0.7 * 10 + 0.3 * 20)
    nothing = forecast_rows(series(4, [0] * 10))
    assert future_of(adjust.ensemble_blend(nothing, last), last) == [10.0] * 3


def test_weights_use_the_last_eight_observed_weeks(forecast_rows):
    last = monday(11)
    rows = forecast_rows(series(1, [100, 100, 100, 100, 5, 5, 5, 5, 5, 5, 5, 5], model=5.0, base=6.0))
    out = adjust.ensemble_weights(rows, last).first()
    assert out.mae_model == 0.0 and out.mae_base == 1.0


def test_anchor_pulls_two_weeks(forecast_rows):
    last = monday(3)
    rows = forecast_rows(series(1, [1, 4, 6, 0]) + series(2, [0, 0, 0, 0]))
    out = future_of(adjust.anchor_forecast(rows, last), last)
    assert out == [6.0, 8.0, 10.0, 10.0, 10.0, 10.0]
    as_is = future_of(adjust.anchor_forecast(rows, last, nonzero=False), last)
    assert as_is[:3] == [0.0, 5.0, 10.0]


def test_nudge_gates_and_sign(forecast_rows):
    last = monday(11)
    rows = forecast_rows(series(1, [5] * 12, model=3.0) + series(2, [0] * 12, model=3.0))
    few = future_of(adjust.residual_nudge(rows, last), last)
    assert few == [10.0] * 6
    cfg = ForecastConfig(nudge_min_rows=20)
    confidence = 0.6 + 0.4 * 12 / 52
    down = future_of(adjust.residual_nudge(rows, last, cfg), last)
    assert down[0] == pytest.approx(10 - 0.35 * confidence * 2)
    assert down[3] == 10.0  # confidence below the bar
    up = future_of(adjust.residual_nudge(rows, last, cfg, direction=1), last)
    assert up[0] == pytest.approx(10 + 0.35 * confidence * 2)


def test_everything_is_future_without_actuals(forecast_rows):
    rows = forecast_rows(series(1, [], future=2))
    never = adjust.NO_ACTUAL
    out = adjust.residual_nudge(adjust.anchor_forecast(adjust.ensemble_blend(rows, never), never), never)
    assert [r.forecast for r in out.collect()] == [10.0, 10.0]
