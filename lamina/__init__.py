"""Batch analytics over layered contract data, expressed as Spark DataFrames."""
