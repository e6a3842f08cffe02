"""Layered (bronze, silver, gold) time-series analytics on Spark DataFrames."""
