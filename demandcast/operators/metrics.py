"""Forecast errors and the chain-month bias table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.config import ForecastConfig
from demandcast.functions.numeric import clip, safe_div
from demandcast.operators.joins import attach_one_row
from demandcast.operators.panel import chain_week_totals


def _absolute_error(actual: Column, forecast: Column) -> Column:
    return F.abs(actual - forecast)


def wape(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of absolute errors over sum of actuals; null where nothing was sold."""
    error = F.sum(_absolute_error(F.col("actual"), F.col("forecast")))
    return rows.groupBy(*by).agg(safe_div(error, F.sum("actual"), None).alias("wape"))


def weighted_mape(rows: DataFrame, by: Sequence[str] = (), forecast: str = "forecast") -> DataFrame:
    """Volume-weighted percentage error over rows with actual > 0; infinite if there are none."""
    sold = F.col("actual") > 0
    error = F.sum(F.when(sold, _absolute_error(F.col("actual"), F.col(forecast))))
    volume = F.sum(F.when(sold, F.col("actual")))
    return rows.groupBy(*by).agg(safe_div(error, volume, float("inf")).alias("wmape"))


def actual_vs_forecast(weekly: DataFrame, forecast: DataFrame) -> DataFrame:
    """Chain-week actual and forecast totals, where both exist."""
    actual = chain_week_totals(weekly).withColumnRenamed("weekly_total", "actual")
    return actual.join(chain_week_totals(forecast, "forecast"), ["chain_id", "week_start"], "inner")


def fallback_bounds(
    months: DataFrame, lookback: int = 6, bounds: tuple[float, float] = (0.65, 1.35), time: str = "month_start"
) -> DataFrame:
    """One row with lower and upper ratio bounds from the last months' actual and forecast totals."""
    recent = months.orderBy(F.col(time).desc()).limit(lookback)
    sums = recent.agg(
        F.coalesce(F.sum("actual"), F.lit(0.0)).alias("a"), F.coalesce(F.sum("forecast"), F.lit(0.0)).alias("f")
    )
    delta = F.abs(F.lit(1.0) - F.col("f") / F.col("a"))
    low, high = F.lit(bounds[0]), F.lit(bounds[1])
    narrow = sums.withColumn("delta", F.when((F.col("a") > 0) & (F.col("f") > 0), delta))
    lo, hi = F.greatest(low, F.lit(1.0) - F.col("delta")), F.least(high, F.lit(1.0) + F.col("delta"))
    usable = F.col("delta").isNotNull() & (lo < hi)
    return narrow.select(F.when(usable, lo).otherwise(low).alias("low"), F.when(usable, hi).otherwise(high).alias("high"))


def bias_groups(
    weekly: DataFrame, forecast: DataFrame, cfg: ForecastConfig = ForecastConfig(), min_weeks: int | None = None
) -> DataFrame:
    """Chain-month actual and forecast sums after exclusions, history gate and volume gate."""
    weeks = actual_vs_forecast(weekly, forecast).where(~F.col("chain_id").isin(*cfg.bias_excluded_chains))
    # weeks: one row per chain and week
    enough = weeks.groupBy("chain_id").agg(F.count("*").alias("weeks")).where(
        F.col("weeks") >= (cfg.bias_min_weeks if min_weeks is None else min_weeks)
    )
    groups = weeks.join(enough, "chain_id", "left_semi").groupBy("chain_id", F.month("week_start").alias("month_num")).agg(
        F.sum("actual").alias("actual_sum"), F.sum("forecast").alias("forecast_sum")
    )
    return groups.where((F.col("actual_sum") >= cfg.bias_min_actual) & (F.col("forecast_sum") > 0))


def damped(alpha: Column) -> Column:
    return F.lit(1.0) + alpha * (F.col("actual_sum") / F.col("forecast_sum") - F.lit(1.0))


def bias_alpha_errors(groups: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Error of each damping factor; alpha 0 is the undamped forecast."""
    alphas = F.array(*[F.lit(a) for a in (0.0, *cfg.bias_alphas)])
    tried = groups.withColumn("alpha", F.explode(alphas)).select(
        "alpha", F.col("actual_sum").alias("actual"), (F.col("forecast_sum") * damped(F.col("alpha"))).alias("forecast")
    )
    return weighted_mape(tried, ["alpha"])


def select_alpha(errors: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """One row: the last alpha that beat the best error so far by the required margin, else null."""
    ladder = F.sort_array(F.collect_list(F.struct("alpha", "wmape")))  # one entry per alpha
    collected = errors.agg(ladder.alias("steps"))
    margin = F.lit(1.0 - cfg.bias_min_improvement)
    start = F.struct(F.lit(None).cast("double").alias("alpha"), F.get("steps", F.lit(0))["wmape"].alias("wmape"))
    better = lambda best, step: F.when(step["wmape"] < best["wmape"] * margin, step).otherwise(best)
    best = F.aggregate(F.slice("steps", 2, len(cfg.bias_alphas)), start, better)
    return collected.where(F.size("steps") > 0).select(
        best["alpha"].alias("best_alpha"), F.get("steps", F.lit(0))["wmape"].alias("base_error"), best["wmape"].alias("best_error")
    )


def bias_table(
    weekly: DataFrame, forecast: DataFrame, cfg: ForecastConfig = ForecastConfig(), min_weeks: int | None = None
) -> DataFrame:
    """Clipped bias factor per chain and calendar month; empty if no damping factor helps."""
    groups = bias_groups(weekly, forecast, cfg, min_weeks)
    chosen = select_alpha(bias_alpha_errors(groups, cfg), cfg).where(F.col("best_alpha").isNotNull())
    return attach_one_row(groups, chosen).select(
        "chain_id", "month_num", clip(damped(F.col("best_alpha")), *cfg.bias_clip).alias("bias_factor")
    )
