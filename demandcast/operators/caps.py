"""Reconciliation, year-over-year caps and smoothing of future forecasts.

Each operator sums the forecast over a chain and a week or month, turns the sum into a factor
and applies it to the rows. Sums are pre-aggregated, so a chain that holds much of the data is
no problem; factors have one row per chain and period and go back through ``lookup_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import season_of_month
from demandcast.functions.numeric import clip, ladder
from demandcast.operators.joins import lookup_join
from demandcast.operators.panel import chain_month_totals, chain_week_totals
from demandcast.operators.seasonality import trend_bias

KEYS = list(SKU)
SPREAD_BY = ["store_id", "product_id"]


def yoy_week_chain(forecast: DataFrame, weekly: DataFrame) -> DataFrame:
    """Chain-week forecast totals next to the chain's actual total 52 weeks earlier."""
    last_year = chain_week_totals(weekly).select(
        "chain_id", F.date_add("week_start", 364).alias("week_start"), F.col("weekly_total").alias("last_year")
    )
    return chain_week_totals(forecast, "forecast").join(last_year, ["chain_id", "week_start"], "left")


def yoy_week_sku(forecast: DataFrame, weekly: DataFrame) -> DataFrame:
    """Forecast rows next to the SKU's actual total 52 weeks earlier."""
    last_year = weekly.select(
        *KEYS, F.date_add("week_start", 364).alias("week_start"), F.col("weekly_total").alias("last_year")
    )
    return forecast.join(last_year, [*KEYS, "week_start"], "left")


def yoy_month_chain(forecast: DataFrame, weekly: DataFrame) -> DataFrame:
    """Chain-month forecast totals next to the chain's actual total 12 months earlier."""
    last_year = chain_month_totals(weekly).select(
        "chain_id", F.add_months("month_start", 12).alias("month_start"), F.col("weekly_total").alias("last_year")
    )
    return chain_month_totals(forecast, "forecast").join(last_year, ["chain_id", "month_start"], "left")


def _scale(rows: DataFrame, factors: DataFrame, on: Sequence[str], max_rows: int | None) -> DataFrame:
    """Multiply the forecast by the group's factor, 1 where there is none."""
    return (
        lookup_join(rows, factors.select(*on, "scale"), on, SPREAD_BY, max_rows=max_rows)
        .withColumn("forecast", F.col("forecast") * F.coalesce("scale", F.lit(1.0)))
        .drop("scale")
    )


def reconcile(rows: DataFrame, targets: DataFrame | None = None, max_groups: int | None = None) -> DataFrame:
    """Scale unlocked rows (actual 0) of each chain-week so that the chain-week total hits a target.

    ``targets`` has ``chain_id, week_start, target``; the default is the current total, which
    leaves everything as it is. Pass the totals from before the SKU caps to win back what they cut.
    A group without unlocked forecast, or whose locked rows already use up the target, is kept.
    """
    free = ~(F.col("actual") > 0)
    groups = rows.groupBy("chain_id", "week_start").agg(
        F.sum("forecast").alias("total"),
        F.coalesce(F.sum(F.when(~free, F.col("forecast"))), F.lit(0.0)).alias("locked"),
        F.coalesce(F.sum(F.when(free, F.col("forecast"))), F.lit(0.0)).alias("free"),
    )
    if targets is not None:
        groups = groups.join(targets.select("chain_id", "week_start", "target"), ["chain_id", "week_start"], "left")
    else:
        groups = groups.withColumn("target", F.col("total"))
    budget = F.coalesce("target", "total") - F.col("locked")
    factors = groups.select(
        "chain_id", "week_start", F.when((budget > 0) & (F.col("free") > 0), budget / F.col("free")).alias("scale")
    )
    on = ["chain_id", "week_start"]
    return (
        lookup_join(rows, factors, on, SPREAD_BY, max_rows=max_groups)
        .withColumn(
            "forecast",
            F.when(free & F.col("scale").isNotNull(), F.col("forecast") * F.col("scale")).otherwise(F.col("forecast")),
        )
        .drop("scale")
    )


def cap_chain_week(
    rows: DataFrame,
    weekly: DataFrame,
    yoy: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    max_groups: int | None = None,
) -> DataFrame:
    """Limit each chain-week total to a multiple of last year's, for chains old enough."""
    totals = yoy_week_chain(rows, weekly).join(yoy.select("chain_id", "use_yoy"), "chain_id", "left")
    limit = F.lit(cfg.chain_week_max_ratio) * F.col("last_year")
    active = F.coalesce("use_yoy", F.lit(False)) & (F.col("last_year") > 0) & (F.col("forecast") > 0)
    factors = totals.withColumn("scale", F.when(active, F.least("forecast", limit) / F.col("forecast")))
    return _scale(rows, factors, ["chain_id", "week_start"], max_groups)


def sku_max_ratio(last_year: Column, cfg: ForecastConfig = ForecastConfig()) -> Column:
    """Upper multiple of last year's week, smaller for larger volumes."""
    return ladder(last_year, [(top, F.lit(r)) for top, r in cfg.sku_ratio_tiers], F.lit(cfg.sku_ratio_above))


def cap_sku_yoy(
    rows: DataFrame,
    weekly: DataFrame,
    yoy: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    max_chains: int | None = None,
) -> DataFrame:
    """Limit each row to a multiple of the SKU's own week last year, for chains old enough."""
    joined = lookup_join(
        yoy_week_sku(rows, weekly), yoy.select("chain_id", "use_yoy"), ["chain_id"], SPREAD_BY, max_rows=max_chains
    )
    limit = sku_max_ratio(F.col("last_year"), cfg) * F.col("last_year")
    active = F.coalesce("use_yoy", F.lit(False)) & (F.col("last_year") > 0)
    return joined.withColumn(
        "forecast", F.when(active, F.least("forecast", limit)).otherwise(F.col("forecast"))
    ).drop("last_year", "use_yoy")


def latest_before(points: DataFrame, events: DataFrame, time: str, value: str) -> DataFrame:
    """For each (chain, ``time``) in ``points``, the last ``value`` in ``events`` strictly before it.

    Points and events are laid on one line per chain and the last event is carried forward, so
    no pairs are formed. Both sides are chain totals: at most one row per chain and period.
    """
    line = points.select("chain_id", F.col(time).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).alias(value)).unionByName(
        events.select("chain_id", F.col(time).alias("_t"), F.lit(1).alias("_kind"), value)
    )
    # at equal times the point comes first, so an event at that time is not "before" it
    earlier = Window.partitionBy("chain_id").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.withColumn("_value", F.last(value, ignorenulls=True).over(earlier))
    return carried.where(F.col("_kind") == 0).select("chain_id", F.col("_t").alias(time), F.col("_value").alias(value))


def recent_actuals_base(forecast_months: DataFrame, actual_months: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Mean of the chain's last six actual months strictly before each forecast month."""
    trailing = Window.partitionBy("chain_id").orderBy("month_start").rowsBetween(1 - cfg.month_recent, 0)
    events = actual_months.withColumn("recent_base", F.avg("weekly_total").over(trailing))
    return latest_before(forecast_months, events, "month_start", "recent_base")


def past_forecast_base(forecast_months: DataFrame, history: DataFrame) -> DataFrame:
    """Mean monthly forecast of the chain in earlier runs, over months before each forecast month."""
    so_far = Window.partitionBy("chain_id").orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    events = chain_month_totals(history, "forecast").withColumn("past_base", F.avg("forecast").over(so_far))
    return latest_before(forecast_months, events, "month_start", "past_base")


def chain_trend(forecast_months: DataFrame, chain_weeks: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Last four weeks against the four before, as of each forecast month, clipped.

    Works on chain-week totals. With four to seven weeks of history the two halves overlap;
    with fewer than four the trend is 1.
    """
    n = cfg.trend_weeks
    by_week = Window.partitionBy("chain_id").orderBy("week_start")
    so_far = by_week.rowsBetween(Window.unboundedPreceding, 0)
    numbered = chain_weeks.withColumn("_rn", F.row_number().over(by_week))
    last = F.sum("weekly_total").over(by_week.rowsBetween(1 - n, 0))
    earlier = F.sum("weekly_total").over(by_week.rowsBetween(1 - 2 * n, -n))
    oldest = F.sum(F.when(F.col("_rn") <= n, F.col("weekly_total"))).over(so_far)
    head = F.when(F.col("_rn") >= 2 * n, earlier).otherwise(oldest)
    ratio = clip((last + F.lit(1e-6)) / (head + F.lit(1e-6)), *cfg.trend_clip)
    events = numbered.withColumn("trend", F.when(F.col("_rn") >= n, ratio).otherwise(F.lit(1.0))).select(
        "chain_id", "week_start", "trend"
    )
    points = forecast_months.select("chain_id", F.col("month_start").alias("week_start"))
    trend = latest_before(points, events, "week_start", "trend")
    return trend.select(
        "chain_id", F.col("week_start").alias("month_start"), F.coalesce("trend", F.lit(1.0)).alias("trend")
    )


def month_bounds(volume: Column, cfg: ForecastConfig = ForecastConfig()) -> tuple[Column, Column]:
    """Lower and upper multiple of a monthly base, tighter for larger volumes."""
    tiers, (low, high) = cfg.month_bound_tiers, cfg.month_bounds_above
    return (
        ladder(volume, [(top, F.lit(lo)) for top, lo, _ in tiers], F.lit(low)),
        ladder(volume, [(top, F.lit(hi)) for top, _, hi in tiers], F.lit(high)),
    )


def month_factors(
    rows: DataFrame,
    weekly: DataFrame,
    yoy: DataFrame,
    directions: DataFrame | None = None,
    history: DataFrame | None = None,
    cfg: ForecastConfig = ForecastConfig(),
    floor: bool = True,
) -> DataFrame:
    """Scale of each chain-month. All inputs are reduced to chain totals first.

    1. Chain old enough and last year's month positive: at most a multiple of that month.
    2. Otherwise bounds around the mean of recent actual months, else of past forecasts, else of
       the forecast itself, shifted by season direction and recent trend. ``floor=False`` keeps
       these bounds from raising a forecast.
    """
    on = ["chain_id", "month_start"]
    totals = yoy_month_chain(rows, weekly)
    points = totals.select(*on)
    frame = totals.join(yoy.select("chain_id", "use_yoy"), "chain_id", "left").join(
        recent_actuals_base(points, chain_month_totals(weekly), cfg), on, "left"
    )
    if history is not None:
        frame = frame.join(past_forecast_base(points, history), on, "left")
    else:
        frame = frame.withColumn("past_base", F.lit(None).cast("double"))
    if directions is not None:
        frame = (
            frame.join(chain_trend(points, chain_week_totals(weekly), cfg), on, "left")
            .withColumn("season", season_of_month(F.month("month_start")))
            .join(directions.select("chain_id", "season", "direction"), ["chain_id", "season"], "left")
            .withColumn(
                "bias", trend_bias(F.coalesce("direction", F.lit(0)), F.coalesce("trend", F.lit(1.0)), cfg)
            )
        )
    else:
        frame = frame.withColumn("bias", F.lit(1.0))

    total = F.col("forecast")
    use_yoy = F.coalesce("use_yoy", F.lit(False)) & (F.col("last_year") > 0)
    known = F.coalesce("recent_base", "past_base")
    tier_low, tier_high = month_bounds(known, cfg)
    low = F.when(known.isNotNull(), tier_low).otherwise(F.lit(cfg.month_bounds_unknown[0]))
    high = F.when(known.isNotNull(), tier_high).otherwise(F.lit(cfg.month_bounds_unknown[1]))
    base = F.when(known > 0, known).otherwise(total)
    frame = frame.withColumns({"_lo": F.greatest(base * low * F.col("bias"), F.lit(0.0)), "_hi": base * high * F.col("bias")})
    hi = F.greatest(F.col("_hi"), F.col("_lo") + F.lit(1e-6))
    bounded = F.least(F.greatest(total, F.col("_lo")) if floor else total, hi)
    yearly = F.least(total, F.lit(cfg.month_max_ratio) * F.col("last_year"))
    return frame.select(
        *on,
        F.when(total > 0, F.when(use_yoy, yearly).otherwise(bounded) / total).otherwise(F.lit(1.0)).alias("scale"),
    )


def with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month_start", F.trunc("week_start", "MM"))


def cap_chain_month(
    rows: DataFrame,
    weekly: DataFrame,
    yoy: DataFrame,
    directions: DataFrame | None = None,
    history: DataFrame | None = None,
    cfg: ForecastConfig = ForecastConfig(),
    floor: bool = True,
    max_groups: int | None = None,
) -> DataFrame:
    """Bound each chain-month total, see ``month_factors``."""
    factors = month_factors(rows, weekly, yoy, directions, history, cfg, floor)
    return _scale(with_month(rows), factors, ["chain_id", "month_start"], max_groups).drop("month_start")


def smooth_month(
    rows: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    keys: Sequence[str] = ("chain_id",),
    max_groups: int | None = None,
) -> DataFrame:
    """Pull unlocked rows of each chain-month towards their mean; the month's total is kept.

    Groups with at most one unlocked row or nothing left to distribute stay as they are. ``keys``
    may name more columns, for instance the whole SKU.
    """
    on = [*keys, "month_start"]
    free = ~(F.col("actual") > 0)
    months = with_month(rows)
    groups = months.groupBy(*on).agg(
        F.count(F.when(free, True)).alias("_free_rows"),
        F.avg(F.when(free, F.col("forecast"))).alias("_free_mean"),
        F.coalesce(F.sum(F.when(free, F.col("forecast"))), F.lit(0.0)).alias("_budget"),
    )
    groups = groups.where((F.col("_free_rows") > 1) & (F.col("_budget") > 0)).select(*on, "_free_mean")
    spread_by = [k for k in KEYS if k not in keys] or ["week_start"]
    pull = F.lit(cfg.smoothing)
    smoothed = (F.lit(1.0) - pull) * F.col("forecast") + pull * F.col("_free_mean")
    return (
        lookup_join(months, groups, on, spread_by, max_rows=max_groups)
        .withColumn(
            "forecast", F.when(free & F.col("_free_mean").isNotNull(), smoothed).otherwise(F.col("forecast"))
        )
        .drop("_free_mean", "month_start")
    )
