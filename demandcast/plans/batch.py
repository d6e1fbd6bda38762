"""The batch run as one entry: history in, forecast out, history updated."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from demandcast.config import ForecastConfig
from demandcast.plans.forecast import as_date, forecast
from demandcast.sources.history import FORECAST_SCHEMA, read_history, write_history_upsert
from demandcast.sources.sinks import write_forecast
from demandcast.sources.storage import Storage


def run_batch(
    sales: DataFrame,
    as_of: str | date,
    history_path: str,
    forecast_path: str,
    cfg: ForecastConfig = ForecastConfig(),
    file_format: str = "parquet",
    **options,
) -> DataFrame:
    """Forecast with the history of runs before ``as_of``, write the forecast, update the history.

    The history keeps its weeks before the first forecast week; from there on it holds this run.
    Returns the forecast as written to ``forecast_path``. ``options`` go to ``forecast``. The run's
    tables are dropped at the end.
    """
    spark, run_date = sales.sparkSession, as_date(as_of)
    storage = Storage(spark)
    history = read_history(spark, history_path, run_date)
    rows = forecast(sales, run_date, cfg, online=False, history=history, storage=storage, **options)
    rows = storage.table("forecast", rows)
    write_forecast(rows, forecast_path, file_format)
    write_history_upsert(rows, run_date, history_path, storage)
    storage.drop()
    reader = spark.read.schema(FORECAST_SCHEMA)
    return reader.option("header", True).csv(forecast_path) if file_format == "csv" else reader.parquet(forecast_path)
