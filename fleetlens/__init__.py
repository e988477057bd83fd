"""Predictive-maintenance analytics on Spark DataFrames."""
