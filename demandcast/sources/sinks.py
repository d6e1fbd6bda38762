"""Forecast, bias and model sinks, and the replace-window write."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.functions.calendar import parse_date, to_date_key
from demandcast.functions.numeric import round_half_even, try_double
from demandcast.operators.joins import lookup_join
from demandcast.sources.sales import require_columns

OUTPUT_ORDER = ["week_start", "chain_id", "store_id", "product_id"]


def date_key(day: Column, type_name: str) -> Column:
    """DATE, YYYYMMDD or other date text to the integer YYYYMMDD; unreadable dates to 0."""
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return F.coalesce(to_date_key(day), F.lit(0))
    text = F.trim(day.cast("string"))
    eight_digits = F.when(text.rlike(r"^\d{8}$"), text.try_cast("int"))
    return F.coalesce(eight_digits, to_date_key(parse_date(text)), F.lit(0))


def upload_projection(rows: DataFrame, algo_id: int | None = None) -> DataFrame:
    """Columns and types of the upload table; ``algo_id`` adds the algorithm and a null supplier."""
    require_columns(rows, [*OUTPUT_ORDER, "forecast"])
    ids = [F.coalesce(F.col(k).try_cast("bigint"), F.lit(0)).alias(k) for k in OUTPUT_ORDER[1:]]
    out = rows.select(
        date_key(F.col("week_start"), dict(rows.dtypes)["week_start"]).alias("date_key"),
        *ids,
        F.coalesce(try_double(F.col("forecast")), F.lit(0.0)).alias("forecast"),
    )
    if algo_id is None:
        return out
    return out.withColumns({"algo_id": F.lit(algo_id), "supplier_id": F.lit(None).cast("bigint")})


def replace_window(target: DataFrame, new: DataFrame) -> DataFrame:
    """Target without rows of the new rows' algorithm and dates, and the new rows."""
    window = new.select("algo_id", "date_key").distinct()
    kept = lookup_join(target, window, ["algo_id", "date_key"], ["store_id", "product_id"], how="left_anti")
    return kept.select(*new.columns).unionByName(new)


def write_replace_window(new: DataFrame, path: str, tasks_per_date: int | None = None, rows_per_file: int = 5_000_000) -> None:
    """Replace the partitions of the new rows' algorithm and dates; all others stay untouched.

    A date's rows are dealt to as many tasks as there are shuffle partitions, unless told
    otherwise; small ones are put together again by the engine. Files hold ``rows_per_file`` at most.
    """
    tasks = tasks_per_date or int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        new.repartition("algo_id", "date_key", F.pmod(F.xxhash64("store_id", "product_id"), F.lit(tasks)))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("algo_id", "date_key")
        .parquet(path)
    )


def jdbc_write_options(url: str, user: str, password: str, table: str, batch_size: int = 500) -> dict[str, str]:
    """Options of a batched JDBC append into a staging table, from which the database swaps the window."""
    given = {"url": url, "user": user, "password": password, "table": table}
    absent = sorted(k for k, v in given.items() if not v)
    if absent:
        raise ValueError(f"missing parameters {absent}")
    return {"url": url, "user": user, "password": password, "dbtable": table, "batchsize": str(batch_size)}


def write_jdbc(rows: DataFrame, options: Mapping[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()


def final_output(rows: DataFrame, first: date, last: date, date_as_int: bool = False, ordered: bool = True) -> DataFrame:
    """Whole non-negative quantities in the window, in output order unless the rows are written to partitions."""
    out = rows.where(F.col("week_start").between(F.lit(first), F.lit(last))).select(
        *OUTPUT_ORDER,
        round_half_even(F.col("actual")).alias("actual"),
        round_half_even(F.col("forecast")).alias("forecast"),
        "pred_model",
        "pred_base",
    )
    if date_as_int:
        out = out.withColumn("week_start", to_date_key(F.col("week_start")))
    return out.orderBy(*OUTPUT_ORDER) if ordered else out


def write_forecast(rows: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a run's forecast; parquet or csv."""
    writer = rows.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_bias_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def append_bias_log(table: DataFrame, run_date: date, path: str) -> None:
    """Add the run's bias factors to the drift log."""
    table.withColumn("run_date", F.lit(run_date)).write.mode("append").parquet(path)


def model_path(folder: str, cutoff: date) -> str:
    """Folder of a cutoff's model, named by the last month it has seen."""
    year, month = (cutoff.year, cutoff.month - 1) if cutoff.day == 1 else (cutoff.year, cutoff.month)
    if month == 0:
        year, month = year - 1, 12
    return f"{folder}/model_{year:04d}{month:02d}"


def save_model(model: PipelineModel, folder: str, cutoff: date) -> str:
    path = model_path(folder, cutoff)
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, cutoff: date) -> PipelineModel:
    return PipelineModel.load(model_path(folder, cutoff))
