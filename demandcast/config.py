"""Parameters of the forecast. Every operator takes a ``ForecastConfig`` or one of its values."""

from __future__ import annotations

from dataclasses import dataclass, field

SKU = ("chain_id", "store_id", "product_id")


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings handed to MLlib."""

    # fixed values: learner settings that results must share
    n_trees: int = 400
    max_depth: int = 6
    step_size: float = 0.05
    row_fraction: float = 0.8
    column_fraction: str = "0.8"
    min_rows_per_leaf: int = 5
    seed: int = 42
    # MLlib knobs without a counterpart in the forecast's definition
    max_bins: int = 64
    min_info_gain: float = 0.0
    checkpoint_interval: int = 10


@dataclass(frozen=True)
class ForecastConfig:
    # fixed values: horizon and gates
    horizon_weeks: int = 4
    min_chain_weeks: int = 8
    min_chain_index_weeks: int = 26
    yoy_history_days: int = 365
    min_fit_rows: int = 200
    min_tuning_rows: int = 500
    tuning_weeks: int = 52

    # fixed values: recency weighting
    recency_default: float = 0.03
    recency_candidates: tuple[float, ...] = (0.01, 0.02, 0.03, 0.05)
    recency_post_bias: float = 1.2
    recency_max: float = 0.08
    high_volume: float = 200.0
    high_volume_boost: float = 0.5

    # fixed values: seasonality lookbacks, shrink and clip bounds
    global_lookback_months: int = 24
    chain_lookback_months: int = 18
    sku_lookback_months: int = 18
    product_lookback_months: int = 24
    global_shrink: tuple[float, float, float] = (0.5, 0.85, 1.15)
    chain_shrink: tuple[float, float, float] = (0.5, 0.80, 1.20)
    sku_shrink: tuple[float, float, float] = (0.4, 0.80, 1.25)
    product_shrink: tuple[float, float, float] = (0.4, 0.85, 1.15)
    direction_dead_band: float = 0.05
    transition_months: tuple[int, ...] = (2, 3, 5, 6, 8, 9, 11, 12)

    # fixed values: dense / sparse rule
    dense_min_average: float = 3.0
    dense_max_zero_rate: float = 0.70

    # fixed values: blend, anchor, nudge
    blend_lookback: int = 8
    blend_low: float = 0.10
    blend_high: float = 0.90
    blend_fallback: float = 0.70
    anchor_weeks: int = 2
    nudge_strength: float = 0.35
    nudge_min_confidence: float = 0.2
    nudge_span: int = 8
    nudge_min_points: int = 3
    nudge_min_rows: int = 100
    confidence_weeks: int = 12

    # fixed values: caps and smoothing
    chain_week_max_ratio: float = 2.0
    sku_ratio_tiers: tuple[tuple[float, float], ...] = ((20.0, 2.5), (100.0, 2.0), (1000.0, 1.5))
    sku_ratio_above: float = 1.2
    month_max_ratio: float = 1.60
    month_bound_tiers: tuple[tuple[float, float, float], ...] = (
        (20.0, 0.60, 1.50),
        (100.0, 0.70, 1.35),
        (500.0, 0.80, 1.25),
    )
    month_bounds_above: tuple[float, float] = (0.90, 1.15)
    month_bounds_unknown: tuple[float, float] = (0.65, 1.35)
    month_recent: int = 6
    trend_weeks: int = 4
    trend_clip: tuple[float, float] = (0.7, 1.3)
    trend_strength: float = 0.30
    trend_bias_clip: tuple[float, float] = (0.85, 1.15)
    smoothing: float = 0.15

    # fixed values: bias table
    bias_excluded_chains: tuple[int, ...] = (1, 2, 3)
    bias_alphas: tuple[float, ...] = (0.05, 0.10, 0.15, 0.20, 0.25)
    bias_min_improvement: float = 0.02
    bias_clip: tuple[float, float] = (0.90, 1.10)
    bias_min_actual: float = 500.0
    bias_min_weeks: int = 104

    # handling of weeks without sales: 0.0 counts them as zero, None leaves them out
    gap_fill: float | None = 0.0

    trees: TreeParams = field(default_factory=TreeParams)
