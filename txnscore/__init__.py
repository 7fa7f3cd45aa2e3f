"""txnscore: transaction scoring analytics on Spark DataFrames, MLlib and Structured Streaming."""

__version__ = "0.1.0"
