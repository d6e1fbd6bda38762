"""Recomputing the bias table from sales and earlier forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from demandcast.config import ForecastConfig
from demandcast.operators.metrics import bias_table
from demandcast.operators.panel import chain_week_totals, clean_sales, weekly_totals
from demandcast.sources.sinks import append_bias_log, write_bias_table
from demandcast.sources.storage import Storage


def update_bias(
    sales: DataFrame,
    forecasts: DataFrame,
    run_date: date,
    table_path: str,
    log_path: str,
    cfg: ForecastConfig = ForecastConfig(),
    min_weeks: int | None = None,
    storage: Storage | None = None,
) -> bool:
    """Write the bias table and add it to the drift log; leave both alone if no factor helps.

    ``forecasts`` has ``chain_id, week_start, forecast`` in any detail. Both inputs are reduced
    to stored chain-week totals first.
    """
    storage = storage or Storage(sales.sparkSession)
    actual = storage.table("bias_actual", chain_week_totals(weekly_totals(clean_sales(sales))))
    forecast = storage.table("bias_forecast", chain_week_totals(forecasts, "forecast"))
    table = storage.table("bias", bias_table(actual, forecast, cfg, min_weeks))
    if table.isEmpty():
        return False
    write_bias_table(table, table_path)
    append_bias_log(table, run_date, log_path)
    return True
