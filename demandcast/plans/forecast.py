"""The whole forecast: sales to adjusted weekly forecasts, in batch and online form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.calendar import mondays, sunday_on_or_after, sunday_on_or_before, week_start
from demandcast.operators import adjust, caps
from demandcast.operators.model import (
    feature_frame,
    model_month,
    sku_inputs,
    train_for_cutoff,
    tree_predictor,
    tune_lambda,
)
from demandcast.operators.panel import (
    assemble_output,
    chain_week_totals,
    clean_sales,
    eligible_chains,
    keep_chains,
    panel_start,
    yoy_eligible,
)
from demandcast.operators.recursion import Predictor, Rule, build_state, fold_forecast, model_forecast
from demandcast.operators.seasonality import season_direction, sku_profiles
from demandcast.sources.history import empty_forecast
from demandcast.sources.sinks import final_output, save_model, upload_projection, write_replace_window
from demandcast.sources.storage import Storage

KEYS = list(SKU)


@dataclass(frozen=True)
class PanelFacts:
    """What the driver knows about a stored panel: one row of aggregates."""

    start: date | None
    last_actual: date | None
    chains: int
    products: int
    chain_products: int


def as_date(day: str | date | datetime) -> date:
    if isinstance(day, datetime):
        return day.date()
    return date.fromisoformat(day) if isinstance(day, str) else day


def panel_facts(weekly: DataFrame) -> PanelFacts:
    """One aggregation over the panel. Its counts bound the sizes of chain and product lookups."""
    pairs = weekly.groupBy("chain_id", "product_id").agg(
        F.min("week_start").alias("start"), F.max("last_sale_day").alias("last")
    )
    row = pairs.agg(
        F.min("start"), F.max("last"), F.count_distinct("chain_id"), F.count_distinct("product_id"), F.count("*")
    ).first()
    return PanelFacts(*row)


def store_panel(sales: DataFrame, storage: Storage) -> DataFrame:
    """Weekly totals, with each week's last day of positive sales, as a stored table.

    Files are sorted by week, so readers of a range of weeks skip row groups.
    """
    clean = clean_sales(sales)
    weekly = clean.groupBy(*KEYS, week_start(F.col("sale_date")).alias("week_start")).agg(
        F.sum("qty").alias("weekly_total"),
        F.max(F.when(F.col("qty") > 0, F.col("sale_date"))).alias("last_sale_day"),
    )
    return storage.table("weekly", weekly.sortWithinPartitions("week_start"))


def forecast_weeks(
    as_of: date, last_actual: date | None, cfg: ForecastConfig, online: bool, window_end: date | None
) -> list[date]:
    """Mondays to forecast.

    Online: ``horizon_weeks`` Mondays after the most recent Sunday. Batch: all Mondays after the
    next Sunday up to ``window_end``, but at most ``horizon_weeks`` past the last actual.
    """
    if online:
        first = sunday_on_or_before(as_of)
        return mondays(first, first + timedelta(weeks=cfg.horizon_weeks))
    first = sunday_on_or_after(as_of)
    limits = [sunday_on_or_after(window_end)] if window_end else []
    if last_actual:
        limits.append(last_actual + timedelta(weeks=cfg.horizon_weeks))
    return mondays(first, min(limits)) if limits else []


def forecast(
    sales: DataFrame,
    as_of: str | date | datetime,
    cfg: ForecastConfig = ForecastConfig(),
    online: bool = True,
    window_end: str | date | None = None,
    rule: Rule | None = None,
    history: DataFrame | None = None,
    date_as_int: bool = False,
    model_folder: str | None = None,
    storage: Storage | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Forecast every eligible SKU for the window's weeks, ``ordered`` by week and SKU.

    SKUs that first sell inside the window are forecast as well.

    ``sales`` has ``chain_id, store_id, product_id, sale_date, qty``. Without ``rule``,
    boosted trees are fitted per calendar month of the window; with it, that column expression is
    the model. ``history`` holds forecasts of earlier runs. Weeks up to the last actual are returned as predicted; later ones are blended,
    anchored, nudged, reconciled, capped and smoothed, in that order.

    The panel, the raw forecasts and the state between adjustments are stored tables of the
    run (see ``Storage``), because later steps read each of them more than once.
    """
    storage = storage or Storage(sales.sparkSession)
    as_of = as_date(as_of)
    everything = store_panel(sales, storage)
    facts = panel_facts(everything)
    origin = sunday_on_or_before(as_of) if online else sunday_on_or_after(as_of)
    weeks = forecast_weeks(as_of, facts.last_actual, cfg, online, as_date(window_end) if window_end else None)
    if facts.start is None or not weeks:
        return empty_forecast(sales.sparkSession)

    # all chain-level figures come from this roll-up, not from the panel
    chain_weeks = storage.table("chain_weeks", chain_week_totals(everything))
    chains = eligible_chains(chain_weeks, origin, cfg.min_chain_weeks)
    chain_weeks = chain_weeks.join(chains.select("chain_id"), "chain_id", "left_semi")
    weekly = keep_chains(everything, chains, max_chains=facts.chains).drop("last_sale_day")
    start = panel_start(chain_weeks)
    if start is None:
        return empty_forecast(sales.sparkSession)

    state = build_state(weekly, [weeks[0]], start, cfg, len(weeks))
    if rule is not None:
        predictions = fold_forecast(state, len(weeks), rule)
    else:
        profiles = sku_profiles(
            weekly, origin, start, cfg, facts.chains, facts.chain_products, facts.products, chain_weeks
        )
        inputs = storage.table("sku_inputs", sku_inputs(weekly, profiles, {"chain_id": facts.chains, "product_id": facts.products}))
        predictor = fit_month_models(weekly, inputs, origin, weeks, start, cfg, model_folder, storage)
        predictions = model_forecast(state.join(inputs, KEYS, "left"), len(weeks), predictor, weeks[0], cfg)
    raw = storage.table("raw", predictions)

    in_window = between_weeks(weekly, weeks[0], weeks[-1])
    rows = assemble_output(raw.select(*KEYS, "week_start", "pred_model", "pred_base"), in_window)
    rows = storage.table("assembled", rows.withColumn("forecast", F.col("pred_model")))
    last_actual = facts.last_actual or adjust.NO_ACTUAL
    # upper bound of rows per chain and week (or month) of the window
    groups = facts.chains * len(weeks)
    year_ago = between_weeks(weekly, weeks[0] - timedelta(days=364), weeks[-1] - timedelta(days=364))
    rows = adjust_future(
        rows, year_ago, chain_weeks, origin, start, last_actual, facts.chains, groups, cfg, history, storage
    )
    return final_output(rows, weeks[0], weeks[-1], date_as_int, ordered)


def between_weeks(weekly: DataFrame, first: date, last: date) -> DataFrame:
    return weekly.where(F.col("week_start").between(F.lit(first), F.lit(last)))


def fit_month_models(
    weekly: DataFrame,
    inputs: DataFrame,
    origin: date,
    weeks: list[date],
    start: date,
    cfg: ForecastConfig,
    model_folder: str | None,
    storage: Storage,
) -> Predictor:
    """Tune lambda once, then fit one model per calendar month that the window touches."""
    rows = storage.table("features", feature_frame(weekly, start, inputs, cfg))
    lam = tune_lambda(rows, origin, cfg)
    models = {}
    for month in sorted({model_month(w) for w in weeks}):
        models[month] = train_for_cutoff(rows, month, lam, cfg)
        if model_folder and models[month] is not None:
            save_model(models[month], model_folder, month)
    return tree_predictor(models)


def adjust_future(
    rows: DataFrame,
    year_ago: DataFrame,
    chain_weeks: DataFrame,
    as_of: date,
    start: date,
    last_actual: date,
    max_chains: int,
    max_groups: int,
    cfg: ForecastConfig,
    history: DataFrame | None,
    storage: Storage,
) -> DataFrame:
    """Post-processing of weeks after ``last_actual``; earlier weeks pass through.

    ``year_ago`` has the SKU totals of the window's weeks one year earlier, ``chain_weeks`` the
    chain totals of all weeks, of which month totals, trends and directions are further roll-ups.
    """
    rows = adjust.ensemble_blend(rows, last_actual, cfg)
    rows = adjust.anchor_forecast(rows, last_actual, cfg)
    rows = storage.table("anchored", rows)
    rows = storage.table("nudged", adjust.residual_nudge(rows, last_actual, cfg))
    past = rows.where(~adjust.is_future(last_actual))
    future = rows.where(adjust.is_future(last_actual))

    yoy = yoy_eligible(chain_weeks, as_of, cfg.yoy_history_days)
    future = caps.reconcile(future, max_groups=max_groups)
    future = caps.cap_chain_week(future, chain_weeks, yoy, cfg, max_groups=max_groups)
    future = storage.table("week_capped", caps.cap_sku_yoy(future, year_ago, yoy, cfg, max_chains=max_chains))
    directions = season_direction(chain_weeks, as_of, start, cfg)
    future = caps.cap_chain_month(future, chain_weeks, yoy, directions, history, cfg, max_groups=max_groups)
    future = caps.smooth_month(storage.table("month_capped", future), cfg, max_groups=max_groups)
    return past.unionByName(future)


def run_and_publish(
    sales: DataFrame,
    as_of: str | date,
    target_path: str,
    algo_id: int,
    cfg: ForecastConfig = ForecastConfig(),
    publish: Callable[[DataFrame, str], None] | None = None,
    **options,
) -> DataFrame:
    """Forecast, then replace the window's rows of this algorithm in the target table.

    Returns the upload rows: those the target now holds for this algorithm and the window's dates,
    after which the run's tables are dropped. ``publish(rows, target_path)`` may replace the
    Parquet sink, for instance by a JDBC staging write; the rows are then read from the run's tables,
    which stay. So do those of a ``storage`` that is passed in.
    """
    own = options.get("storage") is None
    storage = options.pop("storage", None) or Storage(sales.sparkSession)
    out = forecast(sales, as_of, cfg, storage=storage, ordered=False, **options)
    upload = storage.table("upload", upload_projection(out, algo_id))
    if publish is not None or not own:
        (publish or write_replace_window)(upload, target_path)
        return upload
    dates = [r["date_key"] for r in upload.select("date_key").distinct().collect()]  # one row per week
    write_replace_window(upload, target_path)
    storage.drop()
    if not dates:
        return sales.sparkSession.createDataFrame([], upload.schema)
    held = sales.sparkSession.read.schema(upload.schema).parquet(target_path)
    return held.where((F.col("algo_id") == algo_id) & F.col("date_key").isin(dates))
