"""Entity resolution on Spark DataFrames."""
