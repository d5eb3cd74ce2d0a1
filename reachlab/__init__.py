"""reachlab: travel-time and reachability analytics on Spark DataFrames."""
