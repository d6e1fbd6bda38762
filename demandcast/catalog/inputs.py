"""Inputs of the registered queries: the sales view over the test tables, and frames made from it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig, TreeParams
from demandcast.operators.features import add_history, baseline
from demandcast.operators.panel import clean_sales, dense_panel, panel_start, weekly_totals, yoy_eligible
from demandcast.sources.storage import Storage

KEYS = list(SKU)
AS_OF = date(2000, 9, 4)
LAST_ACTUAL = date(2000, 9, 3)
END = AS_OF + timedelta(weeks=3)
BACK_WEEKS = 16
WINDOW_START = AS_OF - timedelta(weeks=BACK_WEEKS)
# the learner's full size is the default of ForecastConfig; registered queries fit few small trees
CFG = ForecastConfig(trees=TreeParams(n_trees=4, max_depth=4, max_bins=32))


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: r6(n) for n in names})


# columns read from each table; naming them saves a pass over the file footers
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "part": "p_partkey bigint, p_brand string",
}


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sales: region = chain, supplier nation = store, part brand = product."""
    lineitem, supplier, nation, part = (
        spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet") for name, columns in TABLES.items()
    )
    stores = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", F.col("n_regionkey").cast("bigint").alias("chain_id"), F.col("s_nationkey").cast("bigint").alias("store_id")
    )
    products = part.select(
        "p_partkey", F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint").alias("product_id")
    )
    return (
        lineitem.join(stores, lineitem.l_suppkey == stores.s_suppkey)
        .join(products, lineitem.l_partkey == products.p_partkey)
        .select(
            *KEYS,
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("l_quantity").alias("qty"),
            "l_orderkey",
            "l_linenumber",
        )
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_totals(clean_sales(sales(spark, sf_dir)))


def stored_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a stored table, for queries that read it many times."""
    return Storage(spark).table("weekly", weekly(spark, sf_dir))


def weekly_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel as it was known on ``AS_OF``."""
    return weekly(spark, sf_dir).where(F.col("week_start") < F.lit(AS_OF))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_panel(weekly(spark, sf_dir), END)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last weeks before ``AS_OF`` and four after it, with two deterministic predictions.

    ``pred_base`` is the baseline rule and ``pred_model`` the 12-week mean, both from lags; weeks
    from ``AS_OF`` on have actual 0 and are the future.
    """
    known = weekly_before(spark, sf_dir)
    start = panel_start(known)
    rows = add_history(dense_panel(known, END, start), start)
    return rows.where(F.col("week_start") >= F.lit(WINDOW_START)).select(
        *KEYS,
        "week_start",
        F.coalesce("weekly_total", F.lit(0.0)).alias("actual"),
        F.col("roll12w").alias("pred_model"),
        baseline().alias("pred_base"),
        F.col("roll12w").alias("forecast"),
    )


def inflated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Future weeks of ``scored`` with a forecast high enough for caps to bind."""
    future = scored(spark, sf_dir).where(F.col("week_start") >= F.lit(AS_OF))
    return future.withColumn("forecast", F.col("pred_model") * 2.5)


def one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observed week with the baseline computed from the weeks before it."""
    panel = weekly(spark, sf_dir)
    return add_history(panel, panel_start(panel)).select(
        *KEYS, "week_start", F.col("weekly_total").alias("actual"), baseline().alias("forecast")
    )


def some_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-over-year eligibility, switched off for odd chains so that fallbacks are used too."""
    known = yoy_eligible(weekly_before(spark, sf_dir), AS_OF)
    return known.withColumn("use_yoy", F.col("use_yoy") & (F.col("chain_id") % 2 == 0))
