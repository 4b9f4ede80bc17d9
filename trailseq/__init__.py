"""Reading-history and embedding-sequence jobs on Spark DataFrames."""
