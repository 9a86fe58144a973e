"""Retail catalogue analytics on Spark DataFrames."""
