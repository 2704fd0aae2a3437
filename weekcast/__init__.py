"""Weekly promotion and demand analytics on Spark DataFrames."""

from weekcast.config import CORRECTED, REFERENCE, ForecastConfig

__all__ = ["CORRECTED", "REFERENCE", "ForecastConfig"]
