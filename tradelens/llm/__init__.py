"""Operators for large training-data corpora, built on Spark DataFrames."""
