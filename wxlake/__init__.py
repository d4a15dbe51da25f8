"""Layered weather analytics on Spark DataFrames."""
