"""Change-log analytics expressed as Spark DataFrames."""
