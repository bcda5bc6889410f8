"""Layered (bronze, silver, gold) warehouse loading on Spark DataFrames."""
