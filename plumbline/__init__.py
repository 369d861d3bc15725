"""Data quality, drift and regression jobs on Spark DataFrames."""
