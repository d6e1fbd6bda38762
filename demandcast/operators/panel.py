"""Raw sales to the weekly panel, its densified grid, and the gates on it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import align_sunday, parse_date, week_no_of, week_start
from demandcast.functions.numeric import clean_quantity
from demandcast.operators.joins import lookup_join

KEYS = list(SKU)


def clean_sales(raw: DataFrame) -> DataFrame:
    """Typed sales rows: dates parsed, bad dates and ids dropped, quantity a number of at least 0."""
    day = F.col("sale_date") if dict(raw.dtypes)["sale_date"] == "date" else parse_date(F.col("sale_date"))
    ids = [F.col(k).try_cast("bigint").alias(k) for k in KEYS]
    return raw.select(*ids, day.alias("sale_date"), clean_quantity(F.col("qty")).alias("qty")).dropna(
        subset=[*KEYS, "sale_date"]
    )


def weekly_totals(sales: DataFrame) -> DataFrame:
    """One row per SKU and week with sales rows. Weeks start on Monday.

    The sum is pre-aggregated per task, so a SKU with very many sales rows stays cheap.
    """
    return sales.groupBy(*KEYS, week_start(F.col("sale_date")).alias("week_start")).agg(
        F.sum("qty").alias("weekly_total")
    )


def panel_start(weekly: DataFrame) -> date | None:
    """First week of the panel: one date, read to the driver so that plans hold it as a literal."""
    return weekly.agg(F.min("week_start")).first()[0]


def chain_week_totals(rows: DataFrame, *values: str) -> DataFrame:
    """Totals per chain and week of the value columns given."""
    return rows.groupBy("chain_id", "week_start").agg(
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in (values or ("weekly_total",))]
    )


def chain_month_totals(rows: DataFrame, *values: str) -> DataFrame:
    """Totals per chain and month. A week belongs to the month of its Monday."""
    month = F.trunc("week_start", "MM").alias("month_start")
    return rows.groupBy("chain_id", month).agg(
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in (values or ("weekly_total",))]
    )


def chain_history(weekly: DataFrame, as_of: date) -> DataFrame:
    """Number of distinct weeks with facts before ``as_of`` and first fact week, per chain."""
    weeks = weekly.select("chain_id", "week_start").distinct()
    return weeks.groupBy("chain_id").agg(
        F.count(F.when(F.col("week_start") < F.lit(as_of), True)).alias("weeks"),
        F.min("week_start").alias("first_week"),
    )


def eligible_chains(weekly: DataFrame, as_of: date, min_weeks: int = 8) -> DataFrame:
    """Chains with at least ``min_weeks`` distinct weeks before ``as_of``."""
    weeks = weekly.where(F.col("week_start") < F.lit(as_of)).select("chain_id", "week_start").distinct()
    return weeks.groupBy("chain_id").agg(F.count("*").alias("weeks")).where(F.col("weeks") >= min_weeks)


def yoy_eligible(weekly: DataFrame, as_of: date, history_days: int = 365) -> DataFrame:
    """Whether a chain's first fact is old enough for year-over-year caps.

    The first date is taken from the facts, not from the densified grid, on which every chain
    would look as old as the oldest one.
    """
    cutoff = as_of - timedelta(days=history_days)
    return weekly.groupBy("chain_id").agg(F.min("week_start").alias("first_week")).withColumn(
        "use_yoy", F.col("first_week") <= F.lit(cutoff)
    )


def keep_chains(rows: DataFrame, chains: DataFrame, max_chains: int | None = None) -> DataFrame:
    """Semi-join to the chains given."""
    return lookup_join(
        rows, chains.select("chain_id"), ["chain_id"], ["store_id", "product_id"], how="left_semi", max_rows=max_chains
    )


def last_actual(sales: DataFrame, horizon_weeks: int = 4) -> DataFrame:
    """One row: last day with a positive quantity and the last day a forecast may reach."""
    last = sales.agg(F.max(F.when(F.col("qty") > 0, F.col("sale_date"))).alias("last_actual"))
    return last.withColumn("forecast_cutoff", F.date_add("last_actual", 7 * horizon_weeks))


def dense_panel(weekly: DataFrame, end: date, start: date | None = None) -> DataFrame:
    """Every SKU for every week from ``start`` (default: first week of the panel) to ``end``.

    Each observed week emits itself and the empty weeks between its predecessor and itself, the
    last one also the empty weeks up to ``end``: one shuffle on the SKU and no join of the grid.
    """
    start = start or panel_start(weekly)
    facts = weekly.where(F.col("week_start").between(F.lit(start), F.lit(end)))
    by_week = Window.partitionBy(*KEYS).orderBy("week_start")
    last_monday = end - timedelta(days=end.weekday())
    spans = facts.select(
        *KEYS,
        "week_start",
        "weekly_total",
        F.coalesce(F.date_add(F.lag("week_start").over(by_week), 7), F.lit(start)).alias("_from"),
        F.when(F.lead("week_start").over(by_week).isNull(), F.lit(last_monday))
        .otherwise(F.col("week_start"))
        .alias("_to"),
    )
    emitted = spans.select(
        *KEYS,
        F.explode(F.sequence("_from", "_to", F.expr("interval 7 days"))).alias("_week"),
        "week_start",
        "weekly_total",
    )
    own = F.when(F.col("_week") == F.col("week_start"), F.col("weekly_total"))
    return emitted.select(
        *KEYS,
        F.col("_week").alias("week_start"),
        own.alias("weekly_total"),
        own.isNotNull().alias("has_actual"),
        own.alias("sim_sales"),
    )


def horizon_rows(rows: DataFrame, as_of: Column, horizon_weeks: int, end: Column, forward: bool = True) -> DataFrame:
    """Rows in the ``horizon_weeks`` weeks from the aligned Sunday of ``as_of``, not past ``end``.

    ``forward`` aligns to the next Sunday, else to the most recent one; a Sunday is kept as it is.
    """
    first = align_sunday(as_of, forward)
    return rows.where(
        (F.col("week_start") >= first)
        & (F.col("week_start") < F.date_add(first, 7 * horizon_weeks))
        & (F.col("week_start") <= end)
    )


def sku_density(weekly: DataFrame, as_of: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Dense flag per SKU from its totals over all panel weeks before ``as_of``.

    The grid gives every SKU the same number of weeks, so the sparse facts suffice.
    """
    weeks = max(1, week_no_of(as_of) - week_no_of(start))
    stats = weekly.where(F.col("week_start") < F.lit(as_of)).groupBy(*KEYS).agg(
        F.sum("weekly_total").alias("total_sales"),
        F.count(F.when(F.col("weekly_total") > 0, True)).alias("nonzero_weeks"),
    )
    return stats.select(
        *KEYS,
        (F.col("total_sales") / F.lit(float(weeks))).alias("avg_weekly"),
        (F.lit(1.0) - F.col("nonzero_weeks") / F.lit(float(weeks))).alias("zero_rate"),
    ).withColumn("is_dense", dense_rule(F.col("avg_weekly"), F.col("zero_rate"), cfg))


def dense_rule(average: Column, zero_rate: Column, cfg: ForecastConfig) -> Column:
    return (average >= F.lit(cfg.dense_min_average)) & (zero_rate <= F.lit(cfg.dense_max_zero_rate))


def last_k_per_sku(rows: DataFrame, k: int, order: str = "week_start") -> DataFrame:
    """The ``k`` most recent rows of each SKU, with their recency rank."""
    recent = Window.partitionBy(*KEYS).orderBy(F.col(order).desc())
    return rows.withColumn("recency", F.row_number().over(recent)).where(F.col("recency") <= k)


def merge_update(panel: DataFrame, predictions: DataFrame, current_week: date) -> DataFrame:
    """Overwrite ``sim_sales`` where a prediction exists for a week from ``current_week`` on."""
    fresh = predictions.where(F.col("week_start") >= F.lit(current_week)).select(*KEYS, "week_start", "prediction")
    return (
        panel.join(fresh, [*KEYS, "week_start"], "left")
        .withColumn("sim_sales", F.coalesce("prediction", "sim_sales"))
        .drop("prediction")
    )


def assemble_output(predictions: DataFrame, weekly: DataFrame) -> DataFrame:
    """Attach actuals to predictions; a week without facts has actual 0."""
    actual = weekly.select(*KEYS, "week_start", F.col("weekly_total").alias("actual"))
    return predictions.join(actual, [*KEYS, "week_start"], "left").withColumn(
        "actual", F.coalesce("actual", F.lit(0.0))
    )
