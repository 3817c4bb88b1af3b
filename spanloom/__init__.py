"""Interval, sequence and table analytics expressed on Spark DataFrames."""
