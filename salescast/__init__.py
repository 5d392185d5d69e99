"""Sales analytics and demand forecasting on Spark DataFrames."""

__version__ = "0.1.0"
