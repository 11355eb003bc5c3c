"""Point-in-time event-series research on Spark DataFrames."""
