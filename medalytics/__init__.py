"""Layered (bronze, silver, gold) analytics as plain PySpark functions from DataFrames to a DataFrame."""
