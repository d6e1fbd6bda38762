"""Blend, anchor and nudge of future forecasts from recent actuals.

``rows`` has one row per SKU and week with ``actual``, ``pred_model``, ``pred_base`` and
``forecast``. Weeks after ``last_actual`` are the future; only they are changed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.numeric import clip
from demandcast.operators.joins import attach_one_row
from demandcast.operators.panel import last_k_per_sku

KEYS = list(SKU)

# stands for "no actual yet": every week is then future
NO_ACTUAL = date(1900, 1, 1)


def is_future(last_actual: date) -> Column:
    return F.col("week_start") > F.lit(last_actual)


def ensemble_weights(rows: DataFrame, last_actual: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Model weight per SKU from both predictors' errors over its last observed weeks."""
    observed = rows.where(~is_future(last_actual) & (F.col("actual") > 0))
    recent = last_k_per_sku(observed, cfg.blend_lookback)
    errors = recent.groupBy(*KEYS).agg(
        F.avg(F.abs(F.col("pred_model") - F.col("actual"))).alias("mae_model"),
        F.avg(F.abs(F.col("pred_base") - F.col("actual"))).alias("mae_base"),
    )
    raw = F.col("mae_base") / (F.col("mae_model") + F.col("mae_base") + F.lit(1e-9))
    return errors.withColumn("w_model", clip(raw, cfg.blend_low, cfg.blend_high))


def ensemble_blend(rows: DataFrame, last_actual: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Weighted mean of model and baseline for future weeks; the model elsewhere.

    SKUs without observed weeks use the fallback weight. Without any observed row at all the
    model's forecast stays as it is.
    """
    weights = ensemble_weights(rows, last_actual, cfg).select(*KEYS, "w_model")
    any_observed = rows.agg(
        F.coalesce(F.max(~is_future(last_actual) & (F.col("actual") > 0)), F.lit(False)).alias("_any")
    )
    w = F.coalesce("w_model", F.lit(cfg.blend_fallback))
    blended = F.greatest(w * F.col("pred_model") + (F.lit(1.0) - w) * F.col("pred_base"), F.lit(0.0))
    joined = attach_one_row(rows.join(weights, KEYS, "left"), any_observed)
    return joined.withColumn(
        "forecast", F.when(is_future(last_actual) & F.col("_any"), blended).otherwise(F.col("forecast"))
    ).drop("w_model", "_any")


def last_actual_per_sku(rows: DataFrame, last_actual: date, nonzero: bool = True) -> DataFrame:
    """Most recent actual of each SKU: the last nonzero one, or the last week's whatever it is."""
    history = rows.where(~is_future(last_actual))
    if nonzero:
        history = history.where(F.col("actual") > 0)
    return history.groupBy(*KEYS).agg(F.max_by("actual", "week_start").alias("actual_last"))


def anchor_forecast(
    rows: DataFrame, last_actual: date, cfg: ForecastConfig = ForecastConfig(), nonzero: bool = True
) -> DataFrame:
    """Pull the first future weeks towards the last actual: fully, half, then not at all."""
    future = is_future(last_actual)
    position = F.row_number().over(Window.partitionBy(*KEYS, future).orderBy("week_start")) - 1
    weight = clip(F.lit(1.0) - position / F.lit(float(cfg.anchor_weeks)), 0.0, 1.0)
    usable = F.col("actual_last").isNotNull() & ((F.col("actual_last") > 0) | F.lit(not nonzero))
    anchored = F.col("_w") * F.col("actual_last") + (F.lit(1.0) - F.col("_w")) * F.col("forecast")
    return (
        rows.withColumn("_w", weight)
        .join(last_actual_per_sku(rows, last_actual, nonzero), KEYS, "left")
        .withColumn("forecast", F.when(future & usable, anchored).otherwise(F.col("forecast")))
        .drop("_w", "actual_last")
    )


def residual_state(rows: DataFrame, last_actual: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Last smoothed residual and confidence of each SKU, in one aggregation over its weeks.

    The residual is an exponentially weighted mean with adjusted weights; it is null below the
    minimum number of points, as is confidence.
    """
    history = rows.where(~is_future(last_actual))
    recency = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.col("week_start").desc()))
    decay = 1.0 - 2.0 / (cfg.nudge_span + 1.0)
    ranked = history.select(
        *KEYS,
        "actual",
        (F.col("actual") - F.col("forecast")).alias("residual"),
        recency.alias("recency"),
    ).withColumn("weight", F.pow(F.lit(decay), F.col("recency") - 1))
    in_window = F.col("recency") <= cfg.confidence_weeks
    points = F.count("*")
    smoothed = F.sum(F.col("residual") * F.col("weight")) / F.sum("weight")
    share = F.avg(F.when(in_window, (F.col("actual") > 0).cast("double")))
    confidence = F.lit(0.6) * share + F.lit(0.4) * F.least(points / F.lit(52.0), F.lit(1.0))
    enough = points >= cfg.nudge_min_points
    return ranked.groupBy(*KEYS).agg(
        points.alias("points"),
        F.when(enough, smoothed).alias("resid_ewma"),
        F.when(enough, clip(confidence, 0.0, 1.0)).alias("confidence"),
    )


def smoothed_residuals(fitted: DataFrame, cfg: ForecastConfig = ForecastConfig(), span: int | None = None) -> DataFrame:
    """Residual and its running smoothed value for every row of ``weekly_total`` and ``y_hat``.

    A SKU's rows, at most one per week, are one array in the order of weeks; one fold over it emits
    all running values. A row without a residual keeps the value before it.
    """
    decay = F.lit(1.0 - 2.0 / ((span or cfg.nudge_span) + 1.0))
    rows = fitted.withColumn("residual", F.col("weekly_total") - F.col("y_hat"))
    others = [c for c in rows.columns if c not in KEYS]
    packed = F.struct("week_start", *[c for c in others if c != "week_start"])
    number, count = F.lit(0.0), F.lit(0)

    def step(acc: Column, row: Column) -> Column:
        r = row["residual"]
        s = F.when(r.isNull(), acc["s"]).otherwise(acc["s"] * decay + r)
        w = F.when(r.isNull(), acc["w"]).otherwise(acc["w"] * decay + 1.0)
        n = acc["n"] + F.when(r.isNull(), 0).otherwise(1)
        value = F.when(n >= cfg.nudge_min_points, s / w)
        return F.struct(s.alias("s"), w.alias("w"), n.alias("n"), F.concat(acc["out"], F.array(value)).alias("out"))

    begin = F.struct(number.alias("s"), number.alias("w"), count.alias("n"), F.array().cast("array<double>").alias("out"))
    sequences = rows.groupBy(*KEYS).agg(F.sort_array(F.collect_list(packed)).alias("_rows"))
    running = F.aggregate("_rows", begin, step, lambda acc: acc["out"])
    zipped = F.explode(F.arrays_zip(F.col("_rows").alias("row"), running.alias("resid_ewma")))
    out = sequences.select(*KEYS, zipped.alias("_each"))
    return out.select(
        *[F.col(c) if c in KEYS else F.col(f"_each.row.{c}").alias(c) for c in rows.columns], "_each.resid_ewma"
    )


def confidence_scores(rows: DataFrame, value: str = "weekly_total", cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Confidence of each row: recent share of nonzero weeks and length of history."""
    by_week = Window.partitionBy(*KEYS).orderBy("week_start")
    recent = by_week.rowsBetween(1 - cfg.confidence_weeks, 0)
    share = F.when(
        F.count(value).over(recent) >= cfg.nudge_min_points, F.avg((F.col(value) > 0).cast("double")).over(recent)
    )
    length = F.least(F.count(value).over(Window.partitionBy(*KEYS)) / F.lit(52.0), F.lit(1.0))
    return rows.withColumn("confidence", clip(F.lit(0.6) * share + F.lit(0.4) * length, 0.0, 1.0))


def residual_nudge(
    rows: DataFrame, last_actual: date, cfg: ForecastConfig = ForecastConfig(), direction: int = -1
) -> DataFrame:
    """Shift future forecasts by the smoothed residual, scaled by confidence.

    ``direction`` -1 subtracts the residual (actual - forecast), +1 adds it, which is the
    correcting sign. Too few history rows overall, or too little confidence, leave the forecast
    alone.
    """
    history_rows = rows.agg(F.count(F.when(~is_future(last_actual), True)).alias("_history_rows"))
    state = residual_state(rows, last_actual, cfg).select(*KEYS, "resid_ewma", "confidence")
    confidence = F.coalesce("confidence", F.lit(0.0))
    shift = F.lit(cfg.nudge_strength) * confidence * F.coalesce("resid_ewma", F.lit(0.0))
    shift = F.when(confidence < cfg.nudge_min_confidence, F.lit(0.0)).otherwise(shift)
    nudged = F.greatest(F.col("forecast") + F.lit(float(direction)) * shift, F.lit(0.0))
    active = is_future(last_actual) & (F.col("_history_rows") >= cfg.nudge_min_rows)
    return (
        attach_one_row(rows.join(state, KEYS, "left"), history_rows)
        .withColumn("forecast", F.when(active, nudged).otherwise(F.col("forecast")))
        .drop("resid_ewma", "confidence", "_history_rows")
    )
