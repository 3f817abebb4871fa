"""Keyed time-series analytics on Spark DataFrames."""
