"""Spark operators for a layered warehouse of market-style time series.

Every operator takes DataFrames and returns a DataFrame: it declares a plan and
never acts on it. Only the sinks and the quality gate run jobs.
"""

__version__ = "0.1.0"
