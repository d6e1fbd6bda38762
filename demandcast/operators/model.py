"""Recency-weighted boosted trees on log1p of the weekly total, with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.config import SKU, ForecastConfig
from demandcast.functions.numeric import is_finite, safe_div
from demandcast.operators.boosting import Boosted, BoostParams, fit_boosted, predict_boosted
from demandcast.operators.features import (
    FEATURES,
    add_calendar,
    add_category_codes,
    add_history,
    add_level,
    baseline,
    impute_lag_52w,
)
from demandcast.operators.recursion import Predictor
from demandcast.operators.seasonality import seasonal_columns
from demandcast.sources.storage import Storage

KEYS = list(SKU)


def with_model_features(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach a SKU's codes and seasonal indices; ``profiles`` has one row per SKU."""
    month, season = F.month("week_start"), F.col("season")
    return (
        rows.join(profiles, KEYS, "left")
        .withColumns(seasonal_columns(month, season))
        .drop("chain_szn", "sku_szn", "product_szn")
    )


def feature_frame(
    weekly: DataFrame, start: date, profiles: DataFrame | None = None, cfg: ForecastConfig = ForecastConfig()
) -> DataFrame:
    """All features of the observed weeks, one row per SKU and week.

    History and level windows and the profile join are all clustered on the SKU, so rows are
    shuffled once; calendar columns come last so that they are not shuffled. ``profiles`` brings
    codes and seasonal indices, see ``sku_inputs``.
    """
    rows = add_calendar(add_level(add_history(weekly, start, cfg), start), cfg)
    return rows if profiles is None else with_model_features(rows, profiles)


def sku_inputs(weekly: DataFrame, profiles: DataFrame, max_ids: Mapping[str, int] | None = None) -> DataFrame:
    """Seasonal profiles with category codes: everything the model needs that is fixed per SKU."""
    return add_category_codes(profiles, weekly, max_ids)


def required_features(features: Sequence[str] = FEATURES) -> list[str]:
    return [c for c in features if c != "lag_52w"]


def is_scorable(features: Sequence[str] = FEATURES) -> Column:
    """All required features are present."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required_features(features)])


def train_rows(rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with a finite target of at least 0 and all required features."""
    target = F.col("weekly_total")
    return rows.where(is_finite(target) & (target >= 0) & is_scorable(features))


def recency_weight(cutoff: date, lam: float, cfg: ForecastConfig = ForecastConfig()) -> Column:
    """exp(-lambda * weeks before the cutoff), with a larger lambda for high-volume rows."""
    weeks = F.greatest(F.datediff(F.lit(cutoff), "week_start") / F.lit(7.0), F.lit(0.0))
    busy = (F.col("avg_nonzero_12w") > cfg.high_volume) | (F.col("roll12w") > cfg.high_volume)
    decay = F.when(busy, F.lit(lam * (1.0 + cfg.high_volume_boost))).otherwise(F.lit(lam))
    return F.exp(-decay * weeks)


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    inputs = ["lag_52w_filled" if c == "lag_52w" else c for c in features]
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")


def fill_lag_52w(rows: DataFrame) -> DataFrame:
    """Trees in MLlib take no missing values: last year's lag gets a substitute of its own name."""
    return rows.withColumn("lag_52w_filled", impute_lag_52w())


def has_rows(rows: DataFrame, n: int) -> bool:
    """Whether there are at least ``n`` rows; reads no more than needed."""
    return rows.limit(n).count() >= n


def learner(cfg: ForecastConfig, weight: str = "weight") -> GBTRegressor:
    """MLlib has no L2 penalty on leaf values; shrinkage, row and column sampling and the minimum
    leaf size carry the regularisation."""
    trees = cfg.trees
    return GBTRegressor(
        maxIter=trees.n_trees,
        maxDepth=trees.max_depth,
        stepSize=trees.step_size,
        subsamplingRate=trees.row_fraction,
        featureSubsetStrategy=trees.column_fraction,
        minInstancesPerNode=trees.min_rows_per_leaf,
        minInfoGain=trees.min_info_gain,
        maxBins=trees.max_bins,
        checkpointInterval=trees.checkpoint_interval,
        seed=trees.seed,
        weightCol=weight,
    )


def training_vectors(
    rows: DataFrame, cutoff: date, lams: Sequence[float], cfg: ForecastConfig, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Feature vector, label and one weight column per lambda (``weight_0``, ...) of the training rows."""
    weights = [recency_weight(cutoff, lam, cfg).alias(f"weight_{i}") for i, lam in enumerate(lams)]
    vectors = assembler(features).transform(fill_lag_52w(train_rows(rows, features)))
    return vectors.select("features", F.log1p("weekly_total").alias("label"), *weights)


def fit_trees(
    rows: DataFrame,
    cutoff: date,
    lam: float,
    cfg: ForecastConfig = ForecastConfig(),
    features: Sequence[str] = FEATURES,
) -> PipelineModel | None:
    """One global model over all SKUs, or None with too few training rows."""
    vectors = training_vectors(rows, cutoff, [lam], cfg, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not has_rows(vectors, cfg.min_fit_rows):
            return None
        return PipelineModel([assembler(features), learner(cfg, "weight_0").fit(vectors)])
    finally:
        vectors.unpersist()


def predict(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``pred_model``: the model on the original scale, 0 for rows that lack a feature."""
    value = F.greatest(F.expm1("prediction"), F.lit(0.0))
    return (
        model.transform(fill_lag_52w(rows))
        .withColumn("pred_model", F.when(is_scorable(features), value).otherwise(F.lit(0.0)))
        .drop("features", "prediction", "lag_52w_filled")
    )


def fitted_values(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """In-sample predictions of the training rows, for residuals."""
    return predict(model, train_rows(rows, features), features).select(
        *KEYS, "week_start", "weekly_total", F.col("pred_model").alias("y_hat")
    )


def model_month(week: date) -> date:
    """Month whose model scores a week: that of the Sunday the week's Monday follows."""
    return (week - timedelta(days=1)).replace(day=1)


def state_predictor(
    model_of: Callable[[date | None], PipelineModel | None], features: Sequence[str] = FEATURES
) -> Predictor:
    """Predictor for the recursion: ``model_of`` names the model of a week, None means the baseline.

    The state carries each SKU's seasonal profile, from which the week's indices are taken.
    """
    seasonal = seasonal_columns(F.col("month"), F.col("season"))

    def score(rows: DataFrame, week: date | None) -> DataFrame:
        model = model_of(week)
        if model is None:
            return rows.withColumn("pred_model", baseline())
        return predict(model, rows.withColumns(seasonal), features)

    return score


def tree_predictor(models: Mapping[date, PipelineModel | None]) -> Predictor:
    """Predictor that uses the model of each week's month, or the baseline if there is none."""
    return state_predictor(lambda week: models.get(model_month(week)))


def fit_regularised(
    rows: DataFrame,
    cutoff: date,
    lams: Sequence[float],
    storage: Storage,
    cfg: ForecastConfig = ForecastConfig(),
    params: BoostParams = BoostParams(),
    features: Sequence[str] = FEATURES,
) -> Boosted:
    """One regularised model per lambda, all grown on one scan a level (see ``boosting``); slots are in the order of ``lams``."""
    inputs = ["lag_52w_filled" if c == "lag_52w" else c for c in features]
    known = fill_lag_52w(train_rows(rows, features))
    weights = [recency_weight(cutoff, lam, cfg) for lam in lams]
    known = known.withColumns({f"_lam{i}": w for i, w in enumerate(weights)})
    return fit_boosted(known, inputs, F.log1p("weekly_total"), [F.col(f"_lam{i}") for i in range(len(lams))], storage, params)


def predict_regularised(model: Boosted, rows: DataFrame, slot: int = 0, features: Sequence[str] = FEATURES, name: str = "pred_model") -> DataFrame:
    """Add the model on the original scale as ``name``, 0 for rows that lack a feature."""
    scored = predict_boosted(model, fill_lag_52w(rows), slot, "_log")
    value = F.greatest(F.expm1("_log"), F.lit(0.0))
    return scored.withColumn(name, F.when(is_scorable(features), value).otherwise(F.lit(0.0))).drop("_log", "lag_52w_filled")


def regularised_lambda_scores(
    rows: DataFrame, as_of: date, storage: Storage, cfg: ForecastConfig = ForecastConfig(), params: BoostParams = BoostParams(), holdout: bool = False
) -> DataFrame:
    """WAPE over the last 52 weeks of each candidate lambda, as ``lambda_scores``, from one fit of all candidates."""
    lams = cfg.recency_candidates
    first = as_of - timedelta(weeks=cfg.tuning_weeks)
    model = fit_regularised(rows.where(F.col("week_start") < F.lit(first if holdout else as_of)), as_of, lams, storage, cfg, params)
    scored = rows.where(F.col("week_start").between(F.lit(first), F.lit(as_of - timedelta(days=1))))
    for i in range(len(lams)):
        scored = predict_regularised(model, scored, i, name=f"_p{i}")
    actual = F.greatest("weekly_total", F.lit(0.0))
    sums = scored.agg(F.sum(actual).alias("sold"), *[F.sum(F.abs(actual - F.col(f"_p{i}"))).alias(f"e_{i}") for i in range(len(lams))])
    pairs = [F.struct(F.lit(lam).alias("lam"), safe_div(F.col(f"e_{i}"), F.col("sold"), None).alias("wape")) for i, lam in enumerate(lams)]
    return sums.select(F.inline(F.array(*pairs)))


def lambda_scores(
    rows: DataFrame, as_of: date, cfg: ForecastConfig = ForecastConfig(), holdout: bool = False
) -> DataFrame:
    """WAPE over the last 52 weeks of a fit with each candidate lambda.

    As defined, the scored rows are trained on; ``holdout`` keeps them out of the fit. Candidates
    share the training vectors, and one pass over the recent weeks scores all of them.
    """
    lams = cfg.recency_candidates
    first = as_of - timedelta(weeks=cfg.tuning_weeks)
    fit_before = first if holdout else as_of
    fit_on = rows.where(F.col("week_start") < F.lit(fit_before))
    vectors = training_vectors(fit_on, as_of, lams, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not has_rows(vectors, cfg.min_fit_rows):
            return rows.sparkSession.createDataFrame([], "lam double, wape double")
        models = [learner(cfg, f"weight_{i}").fit(vectors) for i in range(len(lams))]
    finally:
        vectors.unpersist()

    recent = rows.where(F.col("week_start").between(F.lit(first), F.lit(as_of - timedelta(days=1))))
    scored = assembler().transform(fill_lag_52w(recent))
    for i, model in enumerate(models):
        scored = model.setPredictionCol(f"p_{i}").transform(scored)
    actual = F.greatest("weekly_total", F.lit(0.0))
    errors = []
    for i in range(len(lams)):
        value = F.when(is_scorable(), F.greatest(F.expm1(f"p_{i}"), F.lit(0.0))).otherwise(F.lit(0.0))
        errors.append(F.sum(F.abs(actual - value)).alias(f"e_{i}"))
    sums = scored.agg(F.sum(actual).alias("sold"), *errors)
    pairs = [
        F.struct(F.lit(lam).alias("lam"), safe_div(F.col(f"e_{i}"), F.col("sold"), None).alias("wape"))
        for i, lam in enumerate(lams)
    ]
    return sums.select(F.inline(F.array(*pairs)))


def tune_lambda(
    rows: DataFrame, as_of: date, cfg: ForecastConfig = ForecastConfig(), holdout: bool = False
) -> float:
    """Best candidate, biased to stronger recency and capped; the default with too little data."""
    history = rows.where(F.col("week_start") < F.lit(as_of))
    recent = history.where(F.col("week_start") >= F.lit(as_of - timedelta(weeks=cfg.tuning_weeks)))
    if not has_rows(history, cfg.min_tuning_rows) or not has_rows(recent, cfg.min_fit_rows):
        return cfg.recency_default
    best = (
        lambda_scores(rows, as_of, cfg, holdout)
        .where(F.col("wape").isNotNull())
        .orderBy("wape", "lam")
        .first()
    )
    return cfg.recency_default if best is None else min(best["lam"] * cfg.recency_post_bias, cfg.recency_max)


def train_for_cutoff(
    rows: DataFrame, cutoff: date, lam: float, cfg: ForecastConfig = ForecastConfig()
) -> PipelineModel | None:
    """Fit on all observed rows before ``cutoff``. Their lags are lags of actuals, not of forecasts."""
    return fit_trees(rows.where(F.col("week_start") < F.lit(cutoff)), cutoff, lam, cfg)
