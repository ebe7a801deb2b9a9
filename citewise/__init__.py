"""Citation analytics on Spark: feeds in, DataFrames out."""
