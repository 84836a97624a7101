"""Weather and aviation data jobs on Spark DataFrames."""
