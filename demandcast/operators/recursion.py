"""Recursive multi-week forecast: each predicted week feeds the lags of later weeks.

A SKU's state is one row that holds its last 52 weeks as an array. A step reads lags from the
array, predicts, and appends the prediction: one shuffle builds the state and none follows,
whatever the horizon. Predictors that are column expressions run as one fold over the horizon
(``fold_forecast``); fitted models run as one narrow projection per step (``model_forecast``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import monday_of_no, month_no, week_no, week_no_of
from demandcast.functions.numeric import first_positive
from demandcast.operators.features import baseline, calendar_columns, mean_of, sample_std_of
from demandcast.operators.panel import dense_rule

KEYS = list(SKU)
STATE_WEEKS = 52

# Prediction from a struct with ``lag_1w, lag_2w, lag_3w, lag_52w`` and ``roll12w``.
Rule = Callable[[Column], Column]
# Adds ``pred_model`` to a frame that has all features of one week.
Predictor = Callable[[DataFrame, date | None], DataFrame]


def rolling_mean(features: Column) -> Column:
    """Stand-in model: the 12-week mean."""
    return F.coalesce(features["roll12w"], F.lit(0.0))


def build_state(
    weekly: DataFrame,
    origins: Sequence[date],
    start: date,
    cfg: ForecastConfig = ForecastConfig(),
    horizon: int | None = None,
) -> DataFrame:
    """One row per SKU and origin, with values from facts before the origin only.

    SKUs are those with facts before the end of ``horizon`` weeks from the origin, or all if it is
    None: a product that is launched inside the window is forecast too, from an empty history
    (sparse, baseline 0), and what it then sells counts as missed.

    Columns: ``hist`` (last 52 weeks, oldest first, null before ``start``), ``last_sale_no``,
    the three-month level, and the dense flag. All come out of one aggregation whose buffers
    have a fixed size, so it combines on the map side.
    """
    facts = weekly.select(
        *KEYS,
        F.col("weekly_total").alias("x"),
        week_no(F.col("week_start")).alias("no"),
        month_no(F.col("week_start")).alias("month"),
    )
    nos = [week_no_of(o) for o in origins]
    if horizon is not None:
        facts = facts.where(F.col("no") < max(nos) + horizon)
    if len(nos) == 1:
        facts = facts.withColumn("origin_no", F.lit(nos[0]))
    else:
        # each fact serves every origin whose window ends after it
        serves = F.array(*[F.lit(n) for n in nos])
        if horizon is not None:
            serves = F.filter(serves, lambda o: o + horizon > F.col("no"))
        facts = facts.withColumn("origin_no", F.explode(serves))
    # an origin may be a Sunday; its first forecast week is the Monday on or after it
    age = F.col("origin_no") - F.col("no")
    first_no = week_no_of(start)
    month_of_origin = month_no(monday_of_no(F.col("origin_no")))
    months_back = month_of_origin - F.col("month")
    before = age > 0
    sold = before & (F.col("x") > 0)
    past = [F.sum(F.when(age == k, F.col("x"))).alias(f"_w{k}") for k in range(STATE_WEEKS, 0, -1)]
    state = facts.groupBy(*KEYS, "origin_no").agg(
        *past,
        F.max(F.when(sold, F.col("no"))).alias("last_sale_no"),
        F.coalesce(F.sum(F.when(before & months_back.between(1, 3), F.col("x"))), F.lit(0.0)).alias("sku_3m_sum"),
        F.coalesce(F.sum(F.when(before, F.col("x"))), F.lit(0.0)).alias("_total"),
        F.count(F.when(sold, True)).alias("_nonzero"),
    )
    gap = F.lit(cfg.gap_fill).cast("double")
    hist = [
        F.coalesce(F.col(f"_w{k}"), F.when(F.col("origin_no") - k >= first_no, gap))
        for k in range(STATE_WEEKS, 0, -1)
    ]
    weeks = F.greatest(F.col("origin_no") - first_no, F.lit(1)).cast("double")
    level_months = F.least(F.lit(3), F.greatest(month_of_origin - (start.year * 12 + start.month - 1), F.lit(0)))
    return state.select(
        *KEYS,
        "origin_no",
        F.array(*hist).alias("hist"),
        "last_sale_no",
        "sku_3m_sum",
        F.coalesce(F.try_divide(F.col("sku_3m_sum"), level_months), F.lit(0.0)).alias("sku_3m_mean"),
        dense_rule(F.col("_total") / weeks, F.lit(1.0) - F.col("_nonzero") / weeks, cfg).alias("is_dense"),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _known(hist: Column, n: int) -> Column:
    """Last ``n`` entries without the padding before the panel's start."""
    return F.filter(F.slice(hist, STATE_WEEKS - n + 1, n), lambda v: v.isNotNull())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chosen(is_dense: Column, model: Column, base: Column) -> Column:
    """Value fed back: the model's for dense SKUs, the baseline's for sparse ones."""
    return F.greatest(F.when(is_dense, model).otherwise(base), F.lit(0.0))


def _prediction(week: Column, model: Column, base: Column, final: Column) -> Column:
    return F.struct(
        week.cast("int").alias("no"), model.alias("pred_model"), base.alias("pred_base"), final.alias("pred_final")
    )


NO_PREDICTIONS = "array<struct<no:int,pred_model:double,pred_base:double,pred_final:double>>"


def _rows(states: DataFrame, predictions: Column) -> DataFrame:
    """One row per SKU, origin and week."""
    # outer: a plain explode makes the optimizer push "not empty" down through all steps, which
    # nests their expressions into one filter; the array always has an entry per step
    rows = states.select(*KEYS, "origin_no", "is_dense", F.explode_outer(predictions).alias("_row"))
    return rows.select(
        *KEYS,
        monday_of_no(F.col("origin_no")).alias("origin"),
        monday_of_no(F.col("_row.no")).alias("week_start"),
        "is_dense",
        "_row.pred_model",
        "_row.pred_base",
        "_row.pred_final",
    )


def fold_forecast(state: DataFrame, steps: int, rule: Rule = rolling_mean) -> DataFrame:
    """Predict ``steps`` weeks from each origin with a column expression as the model.

    The steps are a fold over the horizon inside one projection, so the plan is the same for any
    horizon. Actuals of forecast weeks never enter the lags.
    """

    def step(acc: Column, i: Column) -> Column:
        hist = acc["hist"]
        lags = [F.get(hist, F.lit(STATE_WEEKS - n)).alias(f"lag_{n}w") for n in (1, 2, 3, 52)]
        roll12w = _let(_known(hist, 12), lambda v: F.try_divide(_total(v), F.size(v)))
        predicted = _let(
            F.struct(*lags, roll12w.alias("roll12w")),
            lambda f: F.struct(
                rule(f).alias("model"),
                first_positive(*[f[c] for c in ("lag_52w", "lag_3w", "lag_2w", "lag_1w", "roll12w")]).alias("base"),
            ),
        )
        row = _let(
            predicted,
            lambda p: _prediction(
                F.col("origin_no") + i, p["model"], p["base"], _chosen(F.col("is_dense"), p["model"], p["base"])
            ),
        )
        return _let(
            row,
            lambda p: F.struct(
                F.concat(F.slice(hist, 2, STATE_WEEKS - 1), F.array(p["pred_final"])).alias("hist"),
                F.concat(acc["out"], F.array(p)).alias("out"),
            ),
        )

    empty = F.struct(F.col("hist").alias("hist"), F.array().cast(NO_PREDICTIONS).alias("out"))
    folded = F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), empty, step, lambda acc: acc["out"])
    return _rows(state, folded)


def _feature_stages(cfg: ForecastConfig) -> list[dict[str, Column]]:
    """Columns of the week after the state's last one, in stages that build on each other."""
    hist = F.col("hist")
    lags = [F.col("lag_1w"), F.col("lag_2w"), F.col("lag_3w")]
    first = {f"lag_{n}w": F.get(hist, F.lit(STATE_WEEKS - n)) for n in (1, 2, 3, 52)}
    first |= {"_last_12": _known(hist, 12), "_last_6": _known(hist, 6), "week_start": monday_of_no(F.col("week_no"))}
    second = {
        "_sum_12": _total(F.col("_last_12")),
        "nonzero_12w": F.size(F.filter("_last_12", lambda v: v > 0)).cast("long"),
        "roll3w": mean_of(lags),
        "volatility_3w": sample_std_of(lags),
        "zero_run_length_6w": F.size(F.filter("_last_6", lambda v: v == 0)),
        "diff_1w": F.col("lag_1w") - F.col("lag_2w"),
        "diff_2w": F.col("lag_2w") - F.col("lag_3w"),
        "weeks_since_last_sale": F.coalesce(F.col("week_no") - F.col("last_sale_no"), F.lit(0)),
        **calendar_columns(F.col("week_start"), cfg),
    }
    third = {
        "roll12w": F.try_divide(F.col("_sum_12"), F.size("_last_12")),
        "avg_nonzero_12w": F.coalesce(F.try_divide(F.col("_sum_12"), F.col("nonzero_12w")), F.lit(0.0)),
    }
    return [first, second, third]


def model_forecast(
    state: DataFrame,
    steps: int,
    predictor: Predictor,
    first_week: date | None = None,
    cfg: ForecastConfig = ForecastConfig(),
) -> DataFrame:
    """Predict ``steps`` weeks from each origin with a fitted model.

    ``first_week`` is the first forecast Monday where all origins agree on it; a predictor that
    changes by calendar month needs it. Column expressions are built once and reused by each step.
    """
    carried = [F.col(c) for c in state.columns if c not in ("hist", "last_sale_no")]
    stages = _feature_stages(cfg)
    base = baseline()
    final = _chosen(F.col("is_dense"), F.col("pred_model"), F.col("pred_base"))
    row = _prediction(F.col("week_no"), F.col("pred_model"), F.col("pred_base"), F.col("pred_final"))
    advance = [
        F.concat(F.slice("hist", 2, STATE_WEEKS - 1), F.array("pred_final")).alias("hist"),
        F.when(F.col("pred_final") > 0, F.col("week_no")).otherwise(F.col("last_sale_no")).alias("last_sale_no"),
        F.concat("_out", F.array(row)).alias("_out"),
        (F.col("week_no") + 1).alias("week_no"),
    ]
    current = state.withColumns({"week_no": F.col("origin_no"), "_out": F.array().cast(NO_PREDICTIONS)})
    for step in range(steps):
        for stage in stages:
            current = current.withColumns(stage)
        week = first_week + timedelta(weeks=step) if first_week else None
        scored = predictor(current, week).withColumn("pred_base", base).withColumn("pred_final", final)
        current = scored.select(*carried, *advance)
    return _rows(current, F.col("_out"))
