"""Columnar feature-engineering operators on Spark DataFrames."""
