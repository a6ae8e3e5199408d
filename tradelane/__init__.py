"""Freight and trade-network analytics on Spark DataFrames."""
