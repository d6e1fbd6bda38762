import math
import random
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.operators import features as feat
from demandcast.operators.panel import dense_panel
from tests.conftest import monday

KEYS = ["chain_id", "store_id", "product_id"]


def by_week(frame):
    return frame.orderBy(*KEYS, "week_start").toPandas()


def test_windows_do_not_cross_sku_borders(weekly):
    rows = weekly(
        {(1, 1, 1): {monday(i): 10 + i for i in range(3)}, (1, 1, 2): {monday(i): 100 + i for i in range(3)}}
    )
    out = by_week(feat.add_history(rows, monday(0)))
    second = out[out.product_id == 2]
    assert math.isnan(second.lag_1w.iloc[0]) and math.isnan(second.roll3w.iloc[0])
    assert second.nonzero_12w.tolist() == [0, 1, 2]
    assert second.weeks_since_last_sale.tolist() == [0, 1, 1]
    assert second.volatility_3w.round(6).tolist() == [0.0, 0.0, round(math.sqrt(0.5), 6)]


def test_sparse_rows_get_the_grid_values(weekly):
    random.seed(3)
    facts = {(1, 1, p): {monday(i): random.choice([0, 1, 5, 9]) for i in range(80) if random.random() < 0.4} for p in range(4)}
    rows = weekly(facts)
    start = min(w for weeks in facts.values() for w in weeks)
    on_grid = feat.add_level(feat.add_history(dense_panel(rows, monday(79), start), start), start)
    on_facts = feat.add_level(feat.add_history(rows, start), start)
    names = [*KEYS, "week_start", *feat.HISTORY, *feat.LEVEL]
    a = by_week(on_grid.where("has_actual").select(*names))
    b = by_week(on_facts.select(*names))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_gap_weeks_can_be_left_out(weekly):
    rows = weekly({(1, 1, 1): {monday(0): 4, monday(2): 6, monday(3): 8}})
    zero = by_week(feat.add_history(rows, monday(0)))
    none = by_week(feat.add_history(rows, monday(0), ForecastConfig(gap_fill=None)))
    assert zero.lag_1w.iloc[1] == 0.0 and zero.roll3w.iloc[1] == 2.0 and zero.zero_run_length_6w.iloc[1] == 1
    assert math.isnan(none.lag_1w.iloc[1]) and none.roll3w.iloc[1] == 4.0 and none.zero_run_length_6w.iloc[1] == 0


def test_weeks_since_sale_with_the_current_week(weekly):
    rows = weekly({(1, 1, 1): {monday(0): 4, monday(1): 0, monday(2): 0, monday(3): 8}})
    before = by_week(feat.add_history(rows, monday(0))).weeks_since_last_sale.tolist()
    within = by_week(feat.add_history(rows, monday(0), include_current=True)).weeks_since_last_sale.tolist()
    assert before == [0, 1, 2, 3] and within == [0, 1, 2, 0]


def test_no_feature_sees_its_own_or_later_weeks(weekly):
    base = {monday(i): float(i % 7) for i in range(60)}
    changed = {**base, **{monday(i): 999.0 for i in range(50, 60)}}
    outs = []
    for facts in (base, changed):
        rows = weekly({(1, 1, 1): facts})
        out = feat.add_level(feat.add_history(rows, monday(0)), monday(0))
        outs.append(by_week(out.where(F.col("week_start") <= F.lit(monday(50))).select("week_start", *KEYS, *feat.HISTORY)))
    pd.testing.assert_frame_equal(*outs)


def test_level_frames(weekly):
    rows = weekly({(1, 1, 1): {date(2000, 1, 3): 1, date(2000, 2, 7): 2, date(2000, 4, 3): 4, date(2000, 4, 10): 8}})
    start = date(2000, 1, 3)
    before = by_week(feat.add_level(rows, start))
    assert before.sku_3m_sum.tolist() == [0, 1, 3, 3] and before.sku_3m_mean.tolist() == [0, 1, 1, 1]
    within = by_week(feat.add_level(rows, start, frame=(-2, 0)))
    assert within.sku_3m_sum.tolist() == [1, 3, 14, 14]


def test_calendar(spark):
    rows = spark.createDataFrame([(date(2025, 12, 29),), (date(2025, 2, 3),), (date(2025, 4, 7),)], "week_start date")
    a, b, c = feat.add_calendar(rows).collect()
    assert (a.week_of_year, a.week_index, a.season) == (1, 2025 * 53 + 1, 1)
    assert (a.transition_flag, a.transition_pos) == (1.0, 1.0)
    assert (b.transition_flag, b.transition_pos, b.season) == (1.0, 0.0, 1)
    assert (c.transition_flag, c.season) == (0.0, 2)


def test_codes_are_ranks_over_all_ranges(spark):
    ids = spark.createDataFrame([(v,) for v in [50, -3, 7, 7, 1000, 2, 10**12, 8, 9]], "chain_id long")
    for slices in (2, 4, 64):
        out = {r.chain_id: r.code for r in feat.category_codes(ids, "chain_id", slices).collect()}
        assert out == {v: i for i, v in enumerate(sorted(out))}


def test_baseline_cascade(spark):
    schema = "lag_52w double, lag_3w double, lag_2w double, lag_1w double, roll12w double"
    rows = [(5.0, 4.0, 3.0, 2.0, 1.0), (0.0, 4.0, 3.0, 2.0, 1.0), (None, 0.0, 3.0, 2.0, 1.0),
            (None, None, None, 2.0, 1.0), (0.0, 0.0, 0.0, 0.0, 1.0), (None, None, None, None, None)]
    assert [r[0] for r in spark.createDataFrame(rows, schema).select(feat.baseline()).collect()] == [5, 4, 3, 2, 1, 0]
