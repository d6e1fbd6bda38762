import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators.features import HISTORY, add_history
from demandcast.operators.panel import dense_panel, sku_density
from demandcast.operators.recursion import build_state, fold_forecast, model_forecast
from demandcast.plans.backtest import backtest
from tests.conftest import monday

KEYS = ["chain_id", "store_id", "product_id"]


def make_facts(seed=5, skus=5, weeks=90):
    random.seed(seed)
    return {
        (1, s, 1): {
            monday(i): random.choice([0, 1, 4, 20]) for i in range(s * 3, weeks) if random.random() < 0.25 + 0.15 * s
        }
        for s in range(skus)
    }


def by_hand(facts, start, origin, steps, dense):
    """Plain restatement: a list per SKU that grows by one prediction per step."""
    first = (origin - start).days // 7
    out = []
    for sku, weeks in facts.items():
        if not any(w < origin for w in weeks):
            continue
        series = [weeks.get(start + timedelta(weeks=i), 0.0) for i in range(first)]
        for step in range(steps):
            last = series[-12:]
            model = sum(last) / len(last)
            lags = [series[-n] if len(series) >= n else 0.0 for n in (52, 3, 2, 1)]
            base = next((v for v in [*lags, model] if v > 0), 0.0)
            final = model if dense[sku] else base
            out.append((*sku, origin + timedelta(weeks=step), model, base, final))
            series.append(final)
    return pd.DataFrame(out, columns=[*KEYS, "week_start", "pred_model", "pred_base", "pred_final"])


def ordered(frame):
    return frame.sort_values([*KEYS, "week_start"]).reset_index(drop=True)


@pytest.mark.parametrize("weeks_before", [5, 40, 80])
def test_equals_a_plain_restatement(weekly, weeks_before):
    facts = make_facts()
    rows = weekly(facts)
    start, origin = monday(0), monday(weeks_before)
    dense = {k: False for k in facts}
    for r in sku_density(rows, origin, start).collect():
        dense[(r.chain_id, r.store_id, r.product_id)] = r.is_dense
    out = fold_forecast(build_state(rows, [origin], start, horizon=0), 8).drop("origin", "is_dense").toPandas()
    expected = by_hand(facts, start, origin, 8, dense)
    pd.testing.assert_frame_equal(ordered(out)[expected.columns], ordered(expected), check_dtype=False)


def test_fold_and_chain_agree(weekly):
    rows = weekly(make_facts(9))
    state = build_state(rows, [monday(70)], monday(0))
    fold = fold_forecast(state, 6).toPandas()
    mean = lambda frame, week: frame.withColumn("pred_model", F.coalesce("roll12w", F.lit(0.0)))
    chain = model_forecast(state, 6, mean, monday(70)).toPandas()
    pd.testing.assert_frame_equal(ordered(fold), ordered(chain))


@pytest.mark.parametrize("gap_fill", [0.0, None])
def test_first_step_features_equal_those_of_the_grid(weekly, gap_fill):
    cfg = ForecastConfig(gap_fill=gap_fill)
    rows = weekly(make_facts(11))
    origin, start = monday(75), monday(0)
    known = rows.where(F.col("week_start") < F.lit(origin))
    seen = {}

    def spy(frame, week):
        seen["frame"] = frame
        return frame.withColumn("pred_model", F.lit(0.0))

    model_forecast(build_state(rows, [origin], start, cfg), 1, spy, origin, cfg)
    names = HISTORY
    grid = add_history(dense_panel(known, origin, start), start, cfg).where(F.col("week_start") == F.lit(origin))
    pd.testing.assert_frame_equal(
        ordered(seen["frame"].select(*KEYS, "week_start", *names).toPandas()),
        ordered(grid.select(*KEYS, "week_start", *names).toPandas()),
        check_dtype=False,
    )


def test_many_origins_equal_single_ones(weekly):
    rows = weekly(make_facts(13))
    origins = [monday(60), monday(70), monday(71)]
    together = backtest(rows, origins, monday(0)).toPandas()
    apart = pd.concat([backtest(rows, [o], monday(0)).toPandas() for o in origins])
    keys = ["origin", *KEYS, "week_start"]
    pd.testing.assert_frame_equal(
        together.sort_values(keys).reset_index(drop=True), apart.sort_values(keys).reset_index(drop=True)
    )


def test_sunday_origin_means_the_next_monday(weekly):
    rows = weekly(make_facts(17))
    sunday = monday(70) - timedelta(days=1)
    a = fold_forecast(build_state(rows, [sunday], monday(0)), 3).toPandas()
    b = fold_forecast(build_state(rows, [monday(70)], monday(0)), 3).toPandas()
    pd.testing.assert_frame_equal(ordered(a), ordered(b))


def test_later_actuals_do_not_matter(weekly):
    facts = make_facts(19)
    rows = weekly(facts)
    cut = rows.where(F.col("week_start") < F.lit(monday(70)))
    outs = [fold_forecast(build_state(r, [monday(70)], monday(0)), 5).toPandas() for r in (rows, cut)]
    pd.testing.assert_frame_equal(ordered(outs[0]), ordered(outs[1]))
    assert isinstance(outs[0].week_start.iloc[0], date)


def test_products_launched_inside_the_window_count_as_missed(weekly):
    facts = {(1, 1, 1): {monday(n): 10.0 for n in range(80)}, (1, 1, 2): {monday(n): 40.0 for n in range(72, 80)}}
    rows, late = weekly(facts), F.col("product_id") == 2
    state = build_state(rows, [monday(70)], monday(0), horizon=4)
    empty = state.where(late).first()
    assert not empty.is_dense and empty.last_sale_no is None and empty.sku_3m_sum == 0 and set(empty.hist) == {0.0}
    assert build_state(rows, [monday(60)], monday(0), horizon=4).where(late).count() == 0
    out = backtest(rows, [monday(60), monday(70)], monday(0))
    missed = out.where(late).toPandas()
    assert missed.origin.nunique() == 1 and missed.forecast.tolist() == [0.0] * 4 and missed.actual.sum() == 80.0
