"""Station time-series analytics on Spark: cleaning, rolling features,
classification, alerts and reports as functions from DataFrames to DataFrames."""
