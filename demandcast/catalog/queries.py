"""Registered queries: one per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.catalog.inputs import (
    AS_OF,
    CFG,
    END,
    KEYS,
    LAST_ACTUAL,
    grid,
    inflated,
    one_step,
    r6,
    rounded,
    sales,
    scored,
    some_yoy,
    stored_weekly,
    weekly,
    weekly_before,
)
from demandcast.config import ForecastConfig
from demandcast.functions.calendar import to_date_key
from demandcast.operators import adjust, caps, metrics, panel, seasonality
from demandcast.operators import features as feat
from demandcast.operators import model as trees
from demandcast.operators.recursion import build_state, fold_forecast, model_forecast, rolling_mean
from demandcast.plans import backtest
from demandcast.plans.batch import run_batch
from demandcast.plans.bias import update_bias
from demandcast.plans.forecast import forecast
from demandcast.sources.history import (
    FILE_NAMES,
    append_history,
    history_before_run,
    history_upsert,
    read_forecasts_csv,
    read_history,
    write_history_upsert,
)
from demandcast.sources.sales import norm_columns, read_sales_csv
from demandcast.sources.sinks import final_output, replace_window, upload_projection, write_forecast, write_replace_window
from demandcast.sources.storage import Storage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BACKTEST_ORIGINS = [AS_OF - timedelta(weeks=4 * i) for i in range(6)]
BACKTEST_LAUNCH = AS_OF - timedelta(weeks=6)
RUN_START = date(2000, 5, 14)
RUN_LAUNCH = date(2000, 7, 3)
UPSERT_FROM = date(2000, 8, 21)
RUN_DATE = date(2000, 9, 4)


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore sets it apart from its operator."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# --- sources and sinks -----------------------------------------------------------------------


@query
def src_csv_clean(spark, sf_dir):
    """Sales written as an untidy CSV and read back through the CSV source."""
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    day = (
        F.when(line % 4 == 0, F.date_format("sale_date", "yyyyMMdd"))
        .when((line % 4 == 3) & (order % 10 == 0), "x")
        .otherwise(F.date_format("sale_date", "yyyy-MM-dd"))
    )
    quantity = F.when(line % 5 == 0, "n/a").when(line % 5 == 1, "-3").otherwise(F.col("qty").cast("string"))
    store = F.when(order % 17 == 0, F.lit(None)).otherwise(F.col("store_id").cast("string"))
    untidy = sales(spark, sf_dir).select(
        day.alias(" Date"),
        F.col("chain_id").cast("string").alias("Cadena "),
        store.alias(" Tienda "),
        F.col("product_id").cast("string").alias("Producto"),
        quantity.alias("Qty"),
        F.lit("extra").alias("Note"),
    )
    path = f"{Storage(spark).folder}/csv"
    untidy.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return read_sales_csv(spark, path)


@query
def norm_columns_(spark, sf_dir):
    named = sales(spark, sf_dir).select(
        to_date_key(F.col("sale_date")).alias("DateKey"),
        F.col("chain_id").alias("Cadena"),
        F.col("store_id").alias("Tienda"),
        F.col("product_id").alias("Producto"),
        F.col("qty").alias("IND_29018"),
    )
    return norm_columns(named)



@query
def clean_sales(spark, sf_dir):
    """Text dates in two formats and unreadable ones, quantities missing and negative."""
    order = F.col("l_orderkey")
    raw = sales(spark, sf_dir).select(
        *KEYS,
        F.when(order % 3 == 0, F.date_format("sale_date", "yyyyMMdd"))
        .when(order % 11 == 0, "2000-13-45")
        .otherwise(F.date_format("sale_date", "yyyy-MM-dd"))
        .alias("sale_date"),
        F.when(order % 7 == 0, F.lit(None))
        .when(order % 7 == 1, (-F.col("qty")).cast("string"))
        .otherwise(F.col("qty").cast("string"))
        .alias("qty"),
    )
    return panel.clean_sales(raw)


def _history(spark, sf_dir):
    return weekly(spark, sf_dir).select(
        "week_start",
        *KEYS,
        F.col("weekly_total").alias("actual"),
        (F.col("weekly_total") * 1.25).alias("forecast"),
        F.date_sub("week_start", 7).alias("forecast_run_date"),
    )


@query
def history_before_run_(spark, sf_dir):
    """History with dates as text, as a CSV would hold them."""
    text = _history(spark, sf_dir).withColumns(
        {
            "week_start": F.date_format("week_start", "yyyyMMdd"),
            "forecast_run_date": F.date_format("forecast_run_date", "yyyy-MM-dd"),
            "forecast": F.when(F.col("product_id") % 5 == 0, "none").otherwise(F.col("forecast").cast("string")),
        }
    )
    return history_before_run(text, RUN_DATE)



@query
def history_upsert_(spark, sf_dir):
    rows = _history(spark, sf_dir)
    new = rows.where(F.col("week_start") >= F.lit(UPSERT_FROM)).withColumn("forecast", F.col("forecast") + 1)
    return history_upsert(rows, new.drop("forecast_run_date"), RUN_DATE)



@query
def stored_history_upsert(spark, sf_dir):
    """The same through stored history: two runs are appended, the second's weeks are replaced in place."""
    rows, path = _history(spark, sf_dir), f"{Storage(spark).folder}/history"
    stored = rows.select(
        "week_start", *KEYS, "actual", "forecast", F.lit(0.0).alias("pred_model"), F.lit(0.0).alias("pred_base")
    ).withColumns({c: F.col(c).cast("bigint") for c in ("actual", "forecast")})
    early = F.col("week_start") < F.lit(UPSERT_FROM - timedelta(weeks=30))
    append_history(stored.where(early), RUN_DATE - timedelta(days=2), path)
    append_history(stored.where(~early), RUN_DATE - timedelta(days=1), path)
    new = stored.where(F.col("week_start").between(F.lit(UPSERT_FROM), F.lit(UPSERT_FROM + timedelta(weeks=9))))
    write_history_upsert(new.withColumn("forecast", F.col("forecast") + 1), RUN_DATE, path)
    return read_history(spark, path, RUN_DATE + timedelta(days=1)).select(
        "week_start", *KEYS, "actual", "forecast", "forecast_run_date"
    )


def _window(spark, sf_dir):
    rows = weekly(spark, sf_dir).select(
        *KEYS, to_date_key(F.col("week_start")).alias("date_key"), F.col("weekly_total").alias("forecast")
    )
    target = rows.withColumn("algo_id", F.explode(F.array(F.lit(1), F.lit(2))))
    new = rows.where(F.col("date_key") >= 20000821).select(
        *KEYS, "date_key", (F.col("forecast") + 0.5).alias("forecast"), F.lit(1).alias("algo_id")
    )
    return target, new


@query
def replace_window_(spark, sf_dir):
    return replace_window(*_window(spark, sf_dir))


@query
def stored_replace_window(spark, sf_dir):
    """The same through a partitioned target."""
    path = f"{Storage(spark).folder}/target"
    target, new = _window(spark, sf_dir)
    write_replace_window(target, path)
    write_replace_window(new.where(F.col("date_key") <= 20001031), path)
    return spark.read.parquet(path).select(*new.columns)



@query
def upload_projection_(spark, sf_dir):
    order = F.col("product_id") % 4
    rows = weekly(spark, sf_dir).select(
        F.when(order == 0, F.date_format("week_start", "yyyyMMdd"))
        .when(order == 1, "someday")
        .otherwise(F.date_format("week_start", "yyyy-MM-dd"))
        .alias("week_start"),
        *KEYS,
        F.when(F.col("store_id") % 3 == 0, F.lit(None)).otherwise(F.col("weekly_total")).alias("forecast"),
    )
    return upload_projection(rows, algo_id=2)



@query
def final_output_(spark, sf_dir):
    return rounded(final_output(scored(spark, sf_dir), AS_OF - timedelta(weeks=8), END, True), "pred_model", "pred_base")



# --- panel and gates -------------------------------------------------------------------------


@query
def weekly_totals(spark, sf_dir):
    return weekly(spark, sf_dir)


@query
def dense_panel(spark, sf_dir):
    return grid(spark, sf_dir)


@query
def chain_week_totals(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rounded(panel.chain_week_totals(rows, "actual", "forecast"), "forecast")


@query
def chain_month_totals(spark, sf_dir):
    return panel.chain_month_totals(weekly_before(spark, sf_dir))


@query
def eligible_chains(spark, sf_dir):
    return panel.eligible_chains(weekly(spark, sf_dir), AS_OF, CFG.min_chain_weeks)


@query
def eligible_sales(spark, sf_dir):
    """Semi-join of the panel to chains with enough history."""
    rows = weekly(spark, sf_dir)
    return panel.keep_chains(rows, panel.eligible_chains(rows, AS_OF, CFG.min_chain_weeks))


@query
def yoy_eligible(spark, sf_dir):
    return panel.yoy_eligible(weekly(spark, sf_dir), AS_OF)


@query
def last_actual(spark, sf_dir):
    return panel.last_actual(panel.clean_sales(sales(spark, sf_dir)), CFG.horizon_weeks)


@query
def horizon_rows(spark, sf_dir):
    return panel.horizon_rows(grid(spark, sf_dir), F.lit(date(2000, 8, 30)), 4, F.lit(END)).select(
        *KEYS, "week_start", "weekly_total"
    )


@query
def sku_density(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    return rounded(panel.sku_density(rows, AS_OF, panel.panel_start(rows), CFG), "avg_weekly", "zero_rate")


@query
def last_k_per_sku(spark, sf_dir):
    return panel.last_k_per_sku(weekly_before(spark, sf_dir), 8)


@query
def merge_update(spark, sf_dir):
    predictions = scored(spark, sf_dir).withColumnRenamed("pred_model", "prediction")
    updated = panel.merge_update(grid(spark, sf_dir), predictions, AS_OF - timedelta(weeks=2))
    return rounded(updated.select(*KEYS, "week_start", "sim_sales"), "sim_sales")


@query
def assemble_output(spark, sf_dir):
    predictions = scored(spark, sf_dir).select(*KEYS, "week_start", "pred_model", "pred_base")
    return rounded(panel.assemble_output(predictions, weekly(spark, sf_dir)), "pred_model", "pred_base")


# --- features --------------------------------------------------------------------------------


def _history_features(spark, sf_dir, *names):
    rows = weekly(spark, sf_dir)
    return rounded(feat.add_history(rows, panel.panel_start(rows), CFG).select(*KEYS, "week_start", *names), *names)


@query
def feat_calendar(spark, sf_dir):
    rows = feat.add_calendar(weekly(spark, sf_dir), CFG)
    return rounded(rows.drop("weekly_total"), "sin_woy", "cos_woy")


@query
def feat_lags(spark, sf_dir):
    return _history_features(spark, sf_dir, "lag_1w", "lag_2w", "lag_3w", "lag_52w", "diff_1w", "diff_2w")


@query
def feat_rolling(spark, sf_dir):
    return _history_features(spark, sf_dir, "roll3w", "roll12w")


@query
def feat_intermittency(spark, sf_dir):
    return _history_features(spark, sf_dir, "nonzero_12w", "avg_nonzero_12w")


@query
def feat_weeks_since_sale(spark, sf_dir):
    return _history_features(spark, sf_dir, "weeks_since_last_sale")


@query
def feat_volatility(spark, sf_dir):
    return _history_features(spark, sf_dir, "volatility_3w")


@query
def feat_zero_run(spark, sf_dir):
    return _history_features(spark, sf_dir, "zero_run_length_6w")


@query
def feat_sku_3m(spark, sf_dir):
    """Level of the three months before, and of the current and two earlier months."""
    rows = weekly(spark, sf_dir)
    start = panel.panel_start(rows)
    before = feat.add_level(rows, start)
    within = feat.add_level(
        before.withColumnsRenamed({"sku_3m_sum": "prev_sum", "sku_3m_mean": "prev_mean"}), start, frame=(-2, 0)
    )
    out = within.withColumnsRenamed({"sku_3m_sum": "curr_sum", "sku_3m_mean": "curr_mean"})
    return rounded(out.drop("weekly_total"), "prev_mean", "curr_mean")


@query
def feat_category_codes(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    return feat.add_category_codes(rows.select(*KEYS).distinct(), rows)


@query
def baseline_forecast(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    scored_rows = feat.add_history(rows, panel.panel_start(rows), CFG).withColumn("pred_base", feat.baseline())
    return rounded(scored_rows.select(*KEYS, "week_start", "pred_base"), "pred_base")


@query
def features(spark, sf_dir):
    """All features of the observed weeks."""
    rows = stored_weekly(spark, sf_dir)
    start = panel.panel_start(rows)
    inputs = trees.sku_inputs(rows, seasonality.sku_profiles(rows, AS_OF, start, CFG))
    out = trees.feature_frame(rows, start, inputs, CFG).select(*KEYS, "week_start", *feat.FEATURES)
    doubles = [n for n, t in out.dtypes if t == "double"]
    return rounded(out, *doubles)


@query
def train_rows(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    names = [c for c in feat.HISTORY if c != "lag_52w"]
    out = trees.train_rows(feat.add_history(rows, panel.panel_start(rows), CFG), feat.HISTORY)
    return out.select(*KEYS, "week_start", r6(F.log1p("weekly_total")).alias("label"), *[r6(c).alias(c) for c in names])


@query
def recency_weights(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    low_bar = ForecastConfig(high_volume=40.0)
    out = feat.add_history(rows, panel.panel_start(rows), CFG).where(F.col("week_start") < F.lit(AS_OF))
    weight = trees.recency_weight(AS_OF, CFG.recency_default, low_bar)
    return out.select(*KEYS, "week_start", r6(weight).alias("weight"))


# --- seasonality -----------------------------------------------------------------------------


def _index(function, spark, sf_dir):
    rows = weekly(spark, sf_dir)
    return rounded(function(rows, AS_OF, panel.panel_start(rows), CFG), "szn_index")


@query
def szn_global(spark, sf_dir):
    return _index(seasonality.global_index, spark, sf_dir)


@query
def szn_chain(spark, sf_dir):
    return _index(seasonality.chain_index, spark, sf_dir)


@query
def szn_sku(spark, sf_dir):
    return _index(seasonality.sku_index, spark, sf_dir)


@query
def szn_product(spark, sf_dir):
    return _index(seasonality.product_index, spark, sf_dir)


@query
def szn_features(spark, sf_dir):
    rows = stored_weekly(spark, sf_dir)
    profiles = seasonality.sku_profiles(rows, AS_OF, panel.panel_start(rows), CFG)
    return rounded(seasonality.add_seasonality(rows, profiles).drop("weekly_total"), *feat.SEASONAL)


@query
def season_direction(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    return seasonality.season_direction(rows, AS_OF, panel.panel_start(rows), CFG)


# --- recursion and backtest ------------------------------------------------------------------


@query
def recursive_baseline(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    state = build_state(rows, [AS_OF], panel.panel_start(rows), CFG, CFG.horizon_weeks)
    out = fold_forecast(state, CFG.horizon_weeks, rolling_mean)
    return rounded(out.drop("origin"), "pred_model", "pred_base", "pred_final")


def _baseline_errors(rows):
    out = backtest.backtest(rows, BACKTEST_ORIGINS, panel.panel_start(rows), CFG)
    errors = metrics.wape(out, ["origin"])
    sizes = out.groupBy("origin").agg(F.count("*").alias("forecasts"), F.sum("actual").alias("actual"))
    return rounded(errors.join(sizes, "origin"), "wape")


def launched(rows, day):
    """Sales in which every fifth product is first sold on ``day``."""
    return rows.where((F.col("product_id") % 5 != 2) | (F.col("sale_date") >= F.lit(day)))


@query
def backtest_baseline(spark, sf_dir):
    """Error of six origins, four weeks apart, in one job."""
    return _baseline_errors(stored_weekly(spark, sf_dir))


@query
def backtest_launches(spark, sf_dir):
    """The same with products that are launched inside the window of one origin."""
    some = launched(sales(spark, sf_dir), BACKTEST_LAUNCH)
    return _baseline_errors(Storage(spark).table("weekly", panel.weekly_totals(panel.clean_sales(some))))


# --- adjustments -----------------------------------------------------------------------------


@query
def ensemble_weights(spark, sf_dir):
    return rounded(
        adjust.ensemble_weights(scored(spark, sf_dir), LAST_ACTUAL, CFG), "mae_model", "mae_base", "w_model"
    )


def _forecast_only(rows):
    return rounded(rows.select(*KEYS, "week_start", "forecast"), "forecast")


@query
def ensemble_blend(spark, sf_dir):
    return _forecast_only(adjust.ensemble_blend(scored(spark, sf_dir), LAST_ACTUAL, CFG))


@query
def last_actual_sku(spark, sf_dir):
    rows = scored(spark, sf_dir)
    nonzero = adjust.last_actual_per_sku(rows, LAST_ACTUAL).withColumnRenamed("actual_last", "last_nonzero")
    return nonzero.join(adjust.last_actual_per_sku(rows, LAST_ACTUAL, nonzero=False), KEYS)


@query
def anchor_forecast(spark, sf_dir):
    return _forecast_only(adjust.anchor_forecast(scored(spark, sf_dir), LAST_ACTUAL, CFG))


@query
def resid_ewma(spark, sf_dir):
    rows = adjust.residual_state(scored(spark, sf_dir), LAST_ACTUAL, CFG)
    return rounded(rows.select(*KEYS, "points", "resid_ewma"), "resid_ewma")


@query
def resid_ewma_series(spark, sf_dir):
    fitted = scored(spark, sf_dir).where(F.col("week_start") < F.lit(AS_OF))
    fitted = fitted.select(*KEYS, "week_start", F.col("actual").alias("weekly_total"), F.col("pred_base").alias("y_hat"))
    out = adjust.smoothed_residuals(fitted, CFG)
    return out.select(*KEYS, "week_start", r6("residual").alias("residual"), F.round("resid_ewma", 8).alias("resid_ewma"))


@query
def confidence(spark, sf_dir):
    rows = adjust.residual_state(scored(spark, sf_dir), LAST_ACTUAL, CFG)
    return rounded(rows.select(*KEYS, "confidence"), "confidence")


@query
def confidence_series(spark, sf_dir):
    rows = adjust.confidence_scores(weekly_before(spark, sf_dir), cfg=CFG)
    return rounded(rows.select(*KEYS, "week_start", "confidence"), "confidence")


@query
def residual_nudge(spark, sf_dir):
    return _forecast_only(adjust.residual_nudge(scored(spark, sf_dir), LAST_ACTUAL, CFG))


# --- caps and smoothing ----------------------------------------------------------------------


@query
def yoy_week_chain(spark, sf_dir):
    return rounded(caps.yoy_week_chain(inflated(spark, sf_dir), weekly_before(spark, sf_dir)), "forecast")


@query
def yoy_week_sku(spark, sf_dir):
    rows = caps.yoy_week_sku(inflated(spark, sf_dir), weekly_before(spark, sf_dir))
    return rounded(rows.select(*KEYS, "week_start", "forecast", "last_year"), "forecast")


@query
def yoy_month_chain(spark, sf_dir):
    return rounded(caps.yoy_month_chain(inflated(spark, sf_dir), weekly_before(spark, sf_dir)), "forecast")


@query
def reconcile(spark, sf_dir):
    """Unlocked rows take up a target 10 % above each chain-week's total."""
    rows = scored(spark, sf_dir)
    targets = panel.chain_week_totals(rows, "forecast").withColumn("target", F.col("forecast") * 1.1)
    # eight digits: at six, exact ties would hang on the order of summation
    return caps.reconcile(rows, targets).select(*KEYS, "week_start", F.round("forecast", 8).alias("forecast"))


@query
def cap_chain_week(spark, sf_dir):
    return _forecast_only(
        caps.cap_chain_week(inflated(spark, sf_dir), weekly_before(spark, sf_dir), some_yoy(spark, sf_dir), CFG)
    )


@query
def cap_sku_yoy(spark, sf_dir):
    return _forecast_only(
        caps.cap_sku_yoy(inflated(spark, sf_dir), weekly_before(spark, sf_dir), some_yoy(spark, sf_dir), CFG)
    )


def _forecast_months(spark, sf_dir):
    return caps.with_month(scored(spark, sf_dir)).select("chain_id", "month_start").distinct()


@query
def recent_actuals_base(spark, sf_dir):
    actual = panel.chain_month_totals(weekly_before(spark, sf_dir))
    return rounded(caps.recent_actuals_base(_forecast_months(spark, sf_dir), actual, CFG), "recent_base")


@query
def past_forecast_base(spark, sf_dir):
    history = history_before_run(_history(spark, sf_dir), RUN_DATE)
    return rounded(caps.past_forecast_base(_forecast_months(spark, sf_dir), history), "past_base")


@query
def chain_trend(spark, sf_dir):
    weeks = panel.chain_week_totals(weekly_before(spark, sf_dir))
    return rounded(caps.chain_trend(_forecast_months(spark, sf_dir), weeks, CFG), "trend")


@query
def cap_chain_month(spark, sf_dir):
    known = weekly_before(spark, sf_dir)
    directions = seasonality.season_direction(known, AS_OF, panel.panel_start(known), CFG)
    return _forecast_only(
        caps.cap_chain_month(inflated(spark, sf_dir), known, some_yoy(spark, sf_dir), directions, cfg=CFG)
    )


@query
def smooth_month(spark, sf_dir):
    return _forecast_only(caps.smooth_month(scored(spark, sf_dir), CFG))


# --- metrics and bias ------------------------------------------------------------------------


@query
def actual_vs_forecast(spark, sf_dir):
    rows = one_step(spark, sf_dir)
    return rounded(metrics.actual_vs_forecast(weekly(spark, sf_dir), rows), "forecast")


@query
def wape_by_chain(spark, sf_dir):
    return rounded(metrics.wape(one_step(spark, sf_dir), ["chain_id"]), "wape")


@query
def wmape_by_chain(spark, sf_dir):
    return rounded(metrics.weighted_mape(one_step(spark, sf_dir), ["chain_id"]), "wmape")


@query
def fallback_bounds(spark, sf_dir):
    months = one_step(spark, sf_dir).groupBy(F.trunc("week_start", "MM").alias("month_start")).agg(
        F.sum("actual").alias("actual"), F.sum("forecast").alias("forecast")
    )
    return rounded(metrics.fallback_bounds(months), "low", "high")


@query
def bias_alpha_errors(spark, sf_dir):
    groups = metrics.bias_groups(weekly(spark, sf_dir), one_step(spark, sf_dir), CFG)
    return rounded(metrics.bias_alpha_errors(groups, CFG), "wmape")


@query
def bias_table(spark, sf_dir):
    return rounded(metrics.bias_table(weekly(spark, sf_dir), one_step(spark, sf_dir), CFG), "bias_factor")


@query
def stored_bias_table(spark, sf_dir):
    """The bias table from forecast files, as the drift log keeps it."""
    folder = Storage(spark).folder
    files = one_step(spark, sf_dir).select("week_start", *KEYS, "actual", "forecast")
    write_forecast(files.withColumnsRenamed({v: k for k, v in FILE_NAMES.items()}), f"{folder}/forecasts", "csv")
    forecasts = read_forecasts_csv(spark, f"{folder}/forecasts")
    update_bias(sales(spark, sf_dir), forecasts, RUN_DATE, f"{folder}/bias", f"{folder}/log", CFG)
    held = spark.read.parquet(f"{folder}/bias").join(spark.read.parquet(f"{folder}/log"), ["chain_id", "month_num", "bias_factor"])
    return rounded(held, "bias_factor")


# --- model -----------------------------------------------------------------------------------


def _stored_features(spark, sf_dir):
    storage = Storage(spark)
    rows = storage.table("weekly", weekly(spark, sf_dir))
    start = panel.panel_start(rows)
    inputs = storage.table("inputs", trees.sku_inputs(rows, seasonality.sku_profiles(rows, AS_OF, start, CFG)))
    return storage.table("features", trees.feature_frame(rows, start, inputs, CFG)), inputs, rows, start


@query
def model_fitted(spark, sf_dir):
    """In-sample values of a fit on all weeks before the origin."""
    rows = _stored_features(spark, sf_dir)[0].where(F.col("week_start") < F.lit(AS_OF))
    return trees.fitted_values(trees.fit_trees(rows, AS_OF, CFG.recency_default, CFG), rows)


@query
def predict_model(spark, sf_dir):
    """One-step model and baseline predictions of the weeks from the origin on."""
    rows = _stored_features(spark, sf_dir)[0]
    model = trees.train_for_cutoff(rows, AS_OF, CFG.recency_default, CFG)
    out = trees.predict(model, rows.where(F.col("week_start") >= F.lit(AS_OF)))
    return out.select(*KEYS, "week_start", "weekly_total", "pred_model", feat.baseline().alias("pred_base"))


@query
def lambda_scores(spark, sf_dir):
    return trees.lambda_scores(_stored_features(spark, sf_dir)[0], AS_OF, CFG)


@query
def recursive_model(spark, sf_dir):
    """Four weeks from the origin with a model trained on what was known then."""
    rows, inputs, panel_rows, start = _stored_features(spark, sf_dir)
    model = trees.train_for_cutoff(rows, AS_OF, CFG.recency_default, CFG)
    state = build_state(panel_rows, [AS_OF], start, CFG).join(inputs, KEYS)
    return model_forecast(state, CFG.horizon_weeks, trees.state_predictor(lambda week: model), AS_OF, CFG)


@query
def backtest_(spark, sf_dir):
    """Error of all origins, each with its own model and its own seasonal profiles."""
    storage = Storage(spark)
    rows = storage.table("weekly", weekly(spark, sf_dir))
    out = backtest.backtest_model(
        rows, BACKTEST_ORIGINS, panel.panel_start(rows), CFG.recency_default, CFG, storage
    )
    return metrics.wape(out, ["origin"])


# --- the whole forecast ----------------------------------------------------------------------


def _known_sales(spark, sf_dir):
    return sales(spark, sf_dir).where(F.col("sale_date") < F.lit(AS_OF))


@query
def forecast_run(spark, sf_dir):
    """Batch forecast of 16 past and 4 future weeks, with the 12-week mean in place of the model."""
    out = forecast(_known_sales(spark, sf_dir), RUN_START, CFG, online=False, rule=rolling_mean)
    return rounded(out, "pred_model", "pred_base")


@query
def forecast_run_launches(spark, sf_dir):
    """The same with products that are first sold inside the window."""
    some = launched(_known_sales(spark, sf_dir), RUN_LAUNCH)
    return rounded(forecast(some, RUN_START, CFG, online=False, rule=rolling_mean), "pred_model", "pred_base")


@query
def batch_runs(spark, sf_dir):
    """Two batch runs a month apart: the second forecasts with the history that the first has left."""
    folder, known = Storage(spark).folder, _known_sales(spark, sf_dir)
    for run, as_of in enumerate((RUN_START - timedelta(weeks=4), RUN_START)):
        out = run_batch(known, as_of, f"{folder}/history", f"{folder}/forecast{run}", CFG, rule=rolling_mean)
    return rounded(out, "pred_model", "pred_base")


@query
def forecast_run_model(spark, sf_dir):
    """Online forecast with boosted trees."""
    return forecast(_known_sales(spark, sf_dir), AS_OF, CFG)
