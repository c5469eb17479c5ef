"""scrubline: cleaning, validating and repairing linked tables with Spark DataFrames."""
