"""Market time series on Spark: bars and economic series as long DataFrames."""

from barloom.track import Track

__all__ = ["Track"]
