"""Event-stream analytics operators on Spark DataFrames."""
