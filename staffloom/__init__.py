"""Workforce data loading and analytics on Spark DataFrames."""
