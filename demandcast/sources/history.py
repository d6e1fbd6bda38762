"""Forecast history: earlier runs' forecasts with the date they were made."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.config import SKU
from demandcast.functions.calendar import parse_date
from demandcast.functions.numeric import try_double
from demandcast.operators.joins import attach_one_row
from demandcast.sources.sales import require_columns
from demandcast.sources.storage import Storage

FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("week_start", T.DateType()),
        T.StructField("chain_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("actual", T.LongType()),
        T.StructField("forecast", T.LongType()),
        T.StructField("pred_model", T.DoubleType()),
        T.StructField("pred_base", T.DoubleType()),
    ]
)
HISTORY_SCHEMA = T.StructType([*FORECAST_SCHEMA.fields, T.StructField("forecast_run_date", T.DateType())])


# fixed values: column names of forecast files and the names used here
FILE_NAMES = {
    "Date": "week_start",
    "Cadena": "chain_id",
    "Tienda": "store_id",
    "Producto": "product_id",
    "Actual": "actual",
    "Forecast": "forecast",
    "Pred_Model": "pred_model",
    "Pred_Base": "pred_base",
}


def empty_forecast(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FORECAST_SCHEMA)


def history_before_run(history: DataFrame, run_date: date) -> DataFrame:
    """Rows of runs strictly before ``run_date``; quantities coerced to numbers."""
    types = dict(history.dtypes)

    def day(name: str):
        return F.col(name) if types[name] == "date" else parse_date(F.col(name))

    def number(name: str):
        return F.coalesce(try_double(F.col(name)), F.lit(0.0))

    dated = history.withColumns({"week_start": day("week_start"), "forecast_run_date": day("forecast_run_date")})
    return dated.where(F.col("forecast_run_date") < F.lit(run_date)).withColumns(
        {"forecast": number("forecast"), "actual": number("actual")}
    )


def _stored_history(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Stored history, or a typed empty frame if there is none yet."""
    try:
        if file_format == "csv":
            text = spark.read.option("header", True).option("inferSchema", False).csv(path)
            return text.withColumnsRenamed(FILE_NAMES)
        return spark.read.schema(HISTORY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA)


def read_history(spark: SparkSession, path: str, run_date: date, file_format: str = "parquet") -> DataFrame:
    """Stored history of runs before ``run_date``, kept in a partition per week. Empty if there is none."""
    return history_before_run(_stored_history(spark, path, file_format), run_date)


def read_forecasts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Forecasts of a CSV file or folder, typed; rows without a readable date or id are dropped."""
    text = spark.read.option("header", True).option("inferSchema", False).csv(path).withColumnsRenamed(FILE_NAMES)
    require_columns(text, ["week_start", *SKU, "forecast"])
    ids = [F.col(k).try_cast("bigint").alias(k) for k in SKU]
    forecast = F.coalesce(try_double(F.col("forecast")), F.lit(0.0)).alias("forecast")
    rows = text.select(parse_date(F.col("week_start")).alias("week_start"), *ids, forecast)
    return rows.dropna(subset=["week_start", *SKU])


def history_upsert(old: DataFrame, new: DataFrame, run_date: date) -> DataFrame:
    """Old rows before the first new week, and the new rows stamped with the run date."""
    first = new.agg(F.min("week_start").alias("_first"))
    kept = attach_one_row(old, first).where(F.col("_first").isNull() | (F.col("week_start") < F.col("_first")))
    return kept.drop("_first").unionByName(new.withColumn("forecast_run_date", F.lit(run_date)))


def _stamped(rows: DataFrame, run_date: date) -> DataFrame:
    """Rows with their run date, in the columns and types of the history."""
    stamped = rows.withColumn("forecast_run_date", F.lit(run_date))
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA])


def append_history(forecast: DataFrame, run_date: date, path: str) -> None:
    """Add a run to the history; its rows join the partitions of their weeks."""
    _stamped(forecast, run_date).write.mode("append").partitionBy("week_start").parquet(path)


def write_history_upsert(new: DataFrame, run_date: date, path: str, storage: Storage | None = None) -> None:
    """Replace the history from the first new week on by the new rows, in place.

    Only partitions of weeks from there on are written or dropped; all earlier ones stay untouched.
    ``new`` is stored first, as it may have been computed from the history. A run that broke off
    can be repeated. Without new rows nothing changes.
    """
    own = storage is None
    storage = storage or Storage(new.sparkSession)
    new = storage.table("history_new", new)
    weeks = {r["week_start"] for r in new.select("week_start").distinct().collect()}  # one row per week
    if weeks:
        stamped = _stamped(new, run_date)
        (
            stamped.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("week_start")
            .parquet(path)
        )
        drop_partitions(new.sparkSession, path, lambda week: week >= min(weeks) and week not in weeks)
    if own:
        storage.drop()


def drop_partitions(spark: SparkSession, path: str, chosen: Callable[[date], bool]) -> None:
    """Delete the week partitions of a stored history for which ``chosen`` holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("week_start=") and name != "week_start=__HIVE_DEFAULT_PARTITION__":
            if chosen(date.fromisoformat(name.partition("=")[2])):
                files.delete(entry.getPath(), True)
