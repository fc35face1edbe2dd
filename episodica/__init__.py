"""Analytics over episode-structured sensor datasets, expressed as Spark DataFrames."""
