"""Company-fundamentals analytics on Spark DataFrames."""
