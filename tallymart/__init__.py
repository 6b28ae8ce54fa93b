"""Daily channel-split counter mart on Spark DataFrames."""
