"""Time-series, ledger, radius and vector analytics on Spark DataFrames."""

__version__ = "0.1.0"
