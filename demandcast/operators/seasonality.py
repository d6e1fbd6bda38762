"""Seasonal indices from history before ``as_of``, their lookups, and season direction.

An index is a group's share of its parent's total, relative to the mean share. The grid makes
every group exist for every month that has panel weeks in the lookback, so the mean divides by
the number of those months. That number follows from the calendar, and the sparse facts suffice.
A group without sales in a month has a neutral index, so only groups with sales are stored.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import mondays, months_before, season_of_month
from demandcast.functions.numeric import clip, shrink_and_clip
from demandcast.operators.joins import SPREAD_FINE, lookup_join
from demandcast.operators.panel import chain_history

KEYS = list(SKU)


def season_number(month: int) -> int:
    return month % 12 // 3 + 1


def covered_months(start: date, as_of: date, lookback_months: int) -> list[int]:
    """Calendar months that have panel weeks in the lookback before ``as_of``."""
    first = max(start, months_before(as_of, lookback_months))
    return sorted({day.month for day in mondays(first, as_of) if day < as_of})


def in_lookback(weekly: DataFrame, as_of: date, lookback_months: int) -> DataFrame:
    """History predicate; reaches the scan as a range filter on ``week_start``."""
    return weekly.where(
        (F.col("week_start") < F.lit(as_of)) & (F.col("week_start") >= F.lit(months_before(as_of, lookback_months)))
    )


def _indices(
    weekly: DataFrame, parent: list[str], bucket: Column, name: str, n_buckets: int, shrink: tuple[float, float, float]
) -> DataFrame:
    """Index of each (parent, bucket). One aggregation, then a window over at most 12 rows per parent."""
    totals = weekly.groupBy(*parent, bucket.alias(name)).agg(F.sum("weekly_total").alias("total"))
    per_parent = Window.partitionBy(*parent)
    mean = F.sum("total").over(per_parent) / F.lit(float(n_buckets))
    return totals.withColumn("szn_index", shrink_and_clip(F.try_divide(F.col("total"), mean), *shrink)).select(
        *parent, name, "szn_index"
    )


def global_index(weekly: DataFrame, as_of: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Month index over all chains; empty if nothing was sold in the lookback."""
    months = covered_months(start, as_of, cfg.global_lookback_months)
    history = in_lookback(weekly, as_of, cfg.global_lookback_months)
    totals = history.groupBy(F.month("week_start").alias("month")).agg(F.sum("weekly_total").alias("total"))
    everything = F.sum("total").over(Window.partitionBy())  # at most 12 rows
    return (
        totals.withColumn("all_months", everything)
        .where(F.col("all_months") > 0)
        .select(
            "month",
            shrink_and_clip(
                F.col("total") * F.lit(float(len(months))) / F.col("all_months"), *cfg.global_shrink
            ).alias("szn_index"),
        )
    )


def chain_index(weekly: DataFrame, as_of: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    months = covered_months(start, as_of, cfg.chain_lookback_months)
    history = in_lookback(weekly, as_of, cfg.chain_lookback_months)
    return _indices(history, ["chain_id"], F.month("week_start"), "month", len(months), cfg.chain_shrink)


def sku_index(weekly: DataFrame, as_of: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Index per chain, product and month (stores of a chain share it)."""
    months = covered_months(start, as_of, cfg.sku_lookback_months)
    history = in_lookback(weekly, as_of, cfg.sku_lookback_months)
    return _indices(history, ["chain_id", "product_id"], F.month("week_start"), "month", len(months), cfg.sku_shrink)


def product_index(weekly: DataFrame, as_of: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Index per product and season over all chains."""
    seasons = {season_number(m) for m in covered_months(start, as_of, cfg.product_lookback_months)}
    history = in_lookback(weekly, as_of, cfg.product_lookback_months)
    season = season_of_month(F.month("week_start"))
    return _indices(history, ["product_id"], season, "season", len(seasons), cfg.product_shrink)


def season_direction(weekly: DataFrame, until: date, start: date, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """+1, 0 or -1 per chain and season: mean year-over-year change of season totals.

    Only panel weeks before ``until`` count; pass ``as_of`` to keep later weeks out. A season's
    year is the calendar year, so December is joined to January of the same year. Every chain has
    a total for every season and year of the panel, 0 where it sold nothing: growth from zero
    counts as +1, zero to zero is ignored.
    """
    slots = sorted({(season_number(d.month), d.year) for d in mondays(start, until) if d < until})
    season = season_of_month(F.month("week_start"))
    history = weekly.where(F.col("week_start") < F.lit(until))
    totals = history.groupBy("chain_id", season.alias("season"), F.year("week_start").alias("year")).agg(
        F.sum("weekly_total").alias("total")
    )
    grid = weekly.select("chain_id").distinct().select(
        "chain_id", F.inline(F.array(*[F.struct(F.lit(s).alias("season"), F.lit(y).alias("year")) for s, y in slots]))
    )
    # from here on: one row per chain, season and year
    filled = grid.join(totals, ["chain_id", "season", "year"], "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
    previous = F.lag("total").over(Window.partitionBy("chain_id", "season").orderBy("year"))
    changes = filled.withColumn("previous", previous).select(
        "chain_id",
        "season",
        F.try_divide(F.col("total"), F.col("previous")).alias("ratio"),
        ((F.col("previous") == 0) & (F.col("total") > 0)).alias("from_zero"),
    )
    mean = F.avg(F.col("ratio") - 1.0)
    band = cfg.direction_dead_band
    return changes.where(F.col("ratio").isNotNull() | F.col("from_zero")).groupBy("chain_id", "season").agg(
        F.when(F.max("from_zero"), 1)
        .when(mean > band, 1)
        .when(mean < -band, -1)
        .otherwise(0)
        .alias("direction")
    )


def _by_slot(indices: DataFrame, keys: list[str], slot: str, size: int, name: str) -> DataFrame:
    """One row per key with its indices as an array by month or season; null where there is none."""
    values = [F.max(F.when(F.col(slot) == i, F.col("szn_index"))) for i in range(1, size + 1)]
    return indices.groupBy(*keys).agg(F.array(*values).alias(name))


def sku_profiles(
    weekly: DataFrame,
    as_of: date,
    start: date,
    cfg: ForecastConfig = ForecastConfig(),
    max_chains: int | None = None,
    max_chain_products: int | None = None,
    max_products: int | None = None,
    chain_weeks: DataFrame | None = None,
) -> DataFrame:
    """One row per SKU with its seasonal indices by month and season, fallbacks applied.

    Chain index: the chain's own if it has enough weeks of history, else the global one, else 1.
    SKU index: its own, else the chain's (without that gate), else the global one, else 1.
    Lookups run on one row per SKU, not per SKU and week; bounds of the lookups' sizes, where
    known, allow them to be broadcast. ``chain_weeks``, the chain totals of ``weekly``, saves
    reading the panel for the chain and global indices.
    """
    by_chain = weekly if chain_weeks is None else chain_weeks
    skus = weekly.select(*KEYS).distinct()
    chain = (
        _by_slot(chain_index(by_chain, as_of, start, cfg), ["chain_id"], "month", 12, "_chain")
        .join(chain_history(by_chain, as_of).select("chain_id", F.col("weeks").alias("_weeks")), "chain_id", "full")
    )
    sku = _by_slot(sku_index(weekly, as_of, start, cfg), ["chain_id", "product_id"], "month", 12, "_sku")
    product = _by_slot(product_index(weekly, as_of, start, cfg), ["product_id"], "season", 4, "_product")
    overall = _by_slot(global_index(by_chain, as_of, start, cfg), [], "month", 12, "_global")

    rows = lookup_join(skus, chain, ["chain_id"], ["store_id", "product_id"], max_rows=max_chains)
    rows = lookup_join(
        rows, sku, ["chain_id", "product_id"], ["store_id"], max_rows=max_chain_products, spread=SPREAD_FINE
    )
    rows = lookup_join(rows, product, ["product_id"], ["chain_id", "store_id"], max_rows=max_products, spread=SPREAD_FINE)
    rows = rows.crossJoin(F.broadcast(overall))  # a global aggregate: always one row

    def entry(name: str, slot: int, covered: bool) -> list[Column]:
        """Stored index, and the neutral one where the grid has the slot but nothing was sold."""
        stored = F.get(F.col(name), F.lit(slot - 1))
        return [stored, F.lit(1.0)] if covered else [stored]

    global_months = covered_months(start, as_of, cfg.global_lookback_months)
    chain_months = covered_months(start, as_of, cfg.chain_lookback_months)
    sku_months = covered_months(start, as_of, cfg.sku_lookback_months)
    old_enough = F.col("_weeks") >= cfg.min_chain_index_weeks
    chain_values, sku_values = [], []
    for m in range(1, 13):
        fallback = [*entry("_global", m, m in global_months), F.lit(1.0)]
        own_chain = F.coalesce(*entry("_chain", m, m in chain_months))
        chain_values.append(F.coalesce(F.when(old_enough, own_chain), *fallback))
        sku_values.append(F.coalesce(*entry("_sku", m, m in sku_months), own_chain, *fallback))
    product_values = [F.coalesce(F.get(F.col("_product"), F.lit(i)), F.lit(1.0)) for i in range(4)]
    return rows.select(
        *KEYS,
        F.array(*chain_values).alias("chain_szn"),
        F.array(*sku_values).alias("sku_szn"),
        F.array(*product_values).alias("product_szn"),
    )


def seasonal_columns(month: Column, season: Column) -> dict[str, Column]:
    """Indices of a row's month and season from its SKU's profile, and their products with the month."""
    chain = F.get(F.col("chain_szn"), month - 1)
    sku = F.get(F.col("sku_szn"), month - 1)
    product = F.get(F.col("product_szn"), season - 1)
    return {
        "chain_szn_index": chain,
        "sku_szn_index": sku,
        "prod_season_index": product,
        "month_chain_szn": month.cast("double") * chain,
        "month_sku_szn": month.cast("double") * sku,
        "month_prod_season": month.cast("double") * product,
    }


def add_seasonality(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach seasonal features. The join is on the whole SKU, so no key has more rows than weeks."""
    month = F.month("week_start")
    return (
        rows.join(profiles, KEYS, "left")
        .withColumns(seasonal_columns(month, season_of_month(month)))
        .drop("chain_szn", "sku_szn", "product_szn")
    )


def trend_bias(direction: Column, trend: Column, cfg: ForecastConfig) -> Column:
    """Soft factor from season direction and recent trend."""
    raw = F.lit(1.0) + F.lit(cfg.trend_strength) * direction * (trend - F.lit(1.0))
    return clip(raw, *cfg.trend_bias_clip)
