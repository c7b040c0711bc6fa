"""Geographic supply and demand analytics on Spark DataFrames and streams."""
