"""Daily table snapshots to an analytics-ready warehouse, on Spark DataFrames."""
