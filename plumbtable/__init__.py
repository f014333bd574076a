"""Data quality, feature preparation, regression scoring and drift monitoring on Spark DataFrames."""

__version__ = "0.1.0"
