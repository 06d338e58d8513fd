"""Matching, ranking and choice analytics on Spark DataFrames."""
