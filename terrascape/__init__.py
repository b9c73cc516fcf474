"""Spatial beneficiary analytics on Spark DataFrames."""
