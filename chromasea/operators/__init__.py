"""DataFrame operators: every function takes and returns Spark DataFrames."""
