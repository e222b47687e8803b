"""Visit-flow extracts over a hospital scheduling warehouse, built on Spark DataFrames."""
