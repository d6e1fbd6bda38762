"""Rolling-origin backtests: forecasts from many past dates, next to what was then sold."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.operators.model import feature_frame, sku_inputs, state_predictor, train_for_cutoff
from demandcast.operators.panel import assemble_output
from demandcast.operators.recursion import Rule, build_state, fold_forecast, model_forecast, rolling_mean
from demandcast.operators.seasonality import sku_profiles
from demandcast.sources.storage import Storage

KEYS = list(SKU)
FITS_AT_ONCE = 3


def backtest(
    weekly: DataFrame,
    origins: Sequence[date],
    start: date,
    cfg: ForecastConfig = ForecastConfig(),
    rule: Rule = rolling_mean,
) -> DataFrame:
    """Forecast ``horizon_weeks`` from every origin in one job.

    Origins are a column of the state, so their number does not change the plan. Fitted models
    differ by origin: for those see ``backtest_model``.
    """
    forecasts = fold_forecast(
        build_state(weekly, origins, start, cfg, cfg.horizon_weeks), cfg.horizon_weeks, rule
    )
    rows = assemble_output(forecasts, weekly)
    return rows.withColumn("forecast", F.col("pred_final"))


def backtest_model(
    weekly: DataFrame,
    origins: Sequence[date],
    start: date,
    lam: float,
    cfg: ForecastConfig,
    storage: Storage,
) -> DataFrame:
    """Forecast from every origin with a model and seasonal profiles of the weeks before it.

    The origins' profiles, features and fits do not depend on each other: they are submitted from
    ``FITS_AT_ONCE`` driver threads and share the cluster.
    """

    def of_origin(origin: date) -> DataFrame:
        inputs = storage.table(f"inputs-{origin}", sku_inputs(weekly, sku_profiles(weekly, origin, start, cfg)))
        known = weekly.where(F.col("week_start") < F.lit(origin))
        features = storage.table(f"features-{origin}", feature_frame(known, start, inputs, cfg))
        model = train_for_cutoff(features, origin, lam, cfg)
        state = build_state(weekly, [origin], start, cfg, cfg.horizon_weeks).join(inputs, KEYS)
        return model_forecast(state, cfg.horizon_weeks, state_predictor(lambda week: model), origin, cfg)

    with ThreadPoolExecutor(FITS_AT_ONCE) as threads:
        forecasts = list(threads.map(inheritable_thread_target(weekly.sparkSession)(of_origin), origins))
    rows = assemble_output(reduce(DataFrame.unionByName, forecasts), weekly)
    return rows.withColumn("forecast", F.col("pred_final"))
