"""Applies change feeds to keyed tables, with Spark DataFrames."""
