"""Calendar, lag, rolling, intermittency and level features.

History features are window functions over one SKU ordered by week *number*, with RANGE frames.
A range frame counts weeks, not rows, so the same code gives the same values on the densified
grid and on the sparse facts, and training never has to build the grid. A SKU has at most one
row per week, so no window partition outgrows the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import month_no, season_of_month, week_angle, week_no, week_no_of
from demandcast.functions.numeric import first_positive
from demandcast.operators.joins import SPREAD_FINE, lookup_join

KEYS = list(SKU)

CALENDAR = [
    "year", "month", "week_of_year", "week_index", "sin_woy", "cos_woy",
]
HISTORY = [
    "lag_1w", "lag_2w", "lag_3w", "lag_52w", "roll3w", "roll12w", "nonzero_12w", "avg_nonzero_12w",
    "weeks_since_last_sale", "volatility_3w", "zero_run_length_6w", "diff_1w", "diff_2w",
]
CODES = ["chain_code", "store_code", "product_code"]
TRANSITION = ["transition_flag", "transition_pos"]
LEVEL = ["sku_3m_sum", "sku_3m_mean"]
SEASONAL = [
    "chain_szn_index", "sku_szn_index", "prod_season_index",
    "month_chain_szn", "month_sku_szn", "month_prod_season",
]
FEATURES = CALENDAR + HISTORY + CODES + TRANSITION + LEVEL + SEASONAL


def calendar_columns(week: Column, cfg: ForecastConfig = ForecastConfig()) -> dict[str, Column]:
    """Calendar features of a week's Monday. ``week_index`` drops at ISO year ends, as defined."""
    month, woy = F.month(week), F.weekofyear(week)
    second_of_pair = list(cfg.transition_months[1::2])
    return {
        "year": F.year(week),
        "month": month,
        "week_of_year": woy,
        "week_index": F.year(week) * 53 + woy,
        "sin_woy": F.sin(week_angle(woy)),
        "cos_woy": F.cos(week_angle(woy)),
        "season": season_of_month(month),
        "transition_flag": F.when(month.isin(*cfg.transition_months), 1.0).otherwise(0.0),
        "transition_pos": F.when(month.isin(*second_of_pair), 1.0).otherwise(0.0),
    }


def add_calendar(rows: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    return rows.withColumns(calendar_columns(F.col("week_start"), cfg))


def mean_of(values: list[Column]) -> Column:
    """Mean of the non-null columns, null if there is none."""
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.try_divide(total, count_of(values))


def count_of(values: list[Column]) -> Column:
    return sum((v.isNotNull().cast("int") for v in values), F.lit(0))


def sample_std_of(values: list[Column]) -> Column:
    """Sample standard deviation of the non-null columns; 0 for fewer than two."""
    mean = mean_of(values)
    squares = sum((F.coalesce((v - mean) * (v - mean), F.lit(0.0)) for v in values), F.lit(0.0))
    return F.coalesce(F.sqrt(F.try_divide(squares, F.greatest(count_of(values) - 1, F.lit(0)))), F.lit(0.0))


def add_history(
    panel: DataFrame,
    start: date,
    cfg: ForecastConfig = ForecastConfig(),
    value: str = "weekly_total",
    include_current: bool = False,
) -> DataFrame:
    """Lag, rolling, intermittency, recency, volatility and zero-run features of each row.

    ``panel`` may be the grid or only its observed weeks. Weeks without facts since ``start``
    count as ``cfg.gap_fill``; weeks before ``start`` do not exist. ``include_current`` lets
    ``weeks_since_last_sale`` see the row's own week, which leaks the target.
    """
    rows = panel.withColumn("_no", week_no(F.col("week_start")))
    by_week = Window.partitionBy(*KEYS).orderBy("_no")
    first_no = F.lit(week_no_of(start))
    x = F.col(value)
    gap = F.lit(cfg.gap_fill).cast("double")

    def lag(n: int) -> Column:
        seen = F.max(x).over(by_week.rangeBetween(-n, -n))
        return F.coalesce(seen, F.when(F.col("_no") - n >= first_no, gap))

    def over_last(n: int, aggregate: Column) -> Column:
        return aggregate.over(by_week.rangeBetween(-n, -1))

    def weeks_in(n: int, observed: Column) -> Column:
        """How many of the last ``n`` weeks count: those that exist, or those observed."""
        return observed if cfg.gap_fill is None else F.least(F.lit(n), F.col("_no") - first_no)

    positive = F.when(x > 0, x)
    last_sale = F.max(F.when(x > 0, F.col("_no"))).over(
        by_week.rangeBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    windows = rows.withColumns(
        {
            "lag_1w": lag(1),
            "lag_2w": lag(2),
            "lag_3w": lag(3),
            "lag_52w": lag(52),
            "_sum_12": over_last(12, F.sum(x)),
            "_count_12": over_last(12, F.count(x)),
            "nonzero_12w": over_last(12, F.count(positive)),
            "_nonzero_6": over_last(6, F.count(positive)),
            "_count_6": over_last(6, F.count(x)),
            "_last_sale": last_sale,
        }
    )
    lags = [F.col("lag_1w"), F.col("lag_2w"), F.col("lag_3w")]
    total_12 = F.coalesce("_sum_12", F.lit(0.0))
    return windows.withColumns(
        {
            "roll3w": mean_of(lags),
            "roll12w": F.try_divide(total_12, weeks_in(12, F.col("_count_12"))),
            "avg_nonzero_12w": F.coalesce(F.try_divide(total_12, F.col("nonzero_12w")), F.lit(0.0)),
            "weeks_since_last_sale": F.coalesce(F.col("_no") - F.col("_last_sale"), F.lit(0)),
            "volatility_3w": sample_std_of(lags),
            "zero_run_length_6w": weeks_in(6, F.col("_count_6")) - F.col("_nonzero_6"),
            "diff_1w": F.col("lag_1w") - F.col("lag_2w"),
            "diff_2w": F.col("lag_2w") - F.col("lag_3w"),
        }
    ).drop("_no", "_sum_12", "_count_12", "_nonzero_6", "_count_6", "_last_sale")


def add_level(
    panel: DataFrame, start: date, value: str = "weekly_total", frame: tuple[int, int] = (-3, -1)
) -> DataFrame:
    """Three-month sum and mean of the SKU's monthly totals.

    ``frame`` is in months relative to the row's month. The default looks at the three months
    before; ``(-2, 0)`` includes the current month, later weeks of it too, which leaks the target.
    The frame is a range over month numbers, so weekly rows need no monthly roll-up and no join.
    """
    low, high = frame
    by_month = Window.partitionBy(*KEYS).orderBy("_month_no").rangeBetween(low, high)
    first = F.lit(start.year * 12 + start.month - 1)
    months = F.least(F.lit(high - low + 1), F.greatest(F.col("_month_no") + high - first + 1, F.lit(0)))
    return (
        panel.withColumn("_month_no", month_no(F.col("week_start")))
        .withColumn("sku_3m_sum", F.coalesce(F.sum(value).over(by_month), F.lit(0.0)))
        .withColumn("sku_3m_mean", F.coalesce(F.try_divide(F.col("sku_3m_sum"), months), F.lit(0.0)))
        .drop("_month_no")
    )


def category_codes(rows: DataFrame, column: str, slices: int = 64) -> DataFrame:
    """Rank of each distinct id (from 0), without sorting all ids in one task.

    At most ``slices`` approximate quantiles split the ids into ranges; ids are numbered within
    their range and shifted by the count of all ids in earlier ranges. Only the range limits
    reach the driver.
    """
    ids = rows.select(column).distinct()
    steps = [i / slices for i in range(1, slices)]
    limits = ids.agg(F.percentile_approx(column, steps, 1000)).first()[0] or []
    limits = sorted(set(limits))
    lower = F.array(*[F.lit(v) for v in limits]).cast("array<bigint>")
    ranged = ids.withColumn("_range", F.size(F.filter(lower, lambda v: v < F.col(column))))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_ids"))
    # one row per range, so at most `slices` rows here
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(column)
    return ranged.join(F.broadcast(offsets), "_range").select(
        column, (F.row_number().over(within) - 1 + F.col("_offset")).cast("int").alias("code")
    )


def add_category_codes(
    rows: DataFrame, ids_from: DataFrame | None = None, max_ids: Mapping[str, int] | None = None
) -> DataFrame:
    """Attach the code of chain, store and product; codes come from the whole id set of ``ids_from``.

    ``max_ids`` has proven upper bounds of the number of ids by key. A key without one is joined by a salted shuffle.
    """
    ids_from = rows if ids_from is None else ids_from
    out = rows
    for key, name in zip(KEYS, CODES):
        codes = category_codes(ids_from, key).withColumnRenamed("code", name)
        others = [k for k in KEYS if k != key]
        out = lookup_join(out, codes, [key], others, max_rows=(max_ids or {}).get(key), spread=SPREAD_FINE)
    return out


def baseline(lag_52w: str = "lag_52w") -> Column:
    """First positive of last year's week, lags 3, 2, 1 and the 12-week mean, else 0."""
    return first_positive(*[F.col(c) for c in (lag_52w, "lag_3w", "lag_2w", "lag_1w", "roll12w")])


def impute_lag_52w() -> Column:
    return F.coalesce("lag_52w", "roll12w", "lag_3w", "lag_1w", F.lit(0.0))
