"""Weekly demand forecasting per (chain, store, product) as Spark DataFrame operators."""

from demandcast.config import ForecastConfig, TreeParams

__all__ = ["ForecastConfig", "TreeParams"]
