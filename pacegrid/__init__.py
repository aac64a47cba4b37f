"""Activity and GPS analytics on Spark: DataFrames in, DataFrames out."""
