"""A transaction warehouse kept and reported on with plain Spark DataFrames."""
