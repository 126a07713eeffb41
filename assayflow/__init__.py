"""Evidence-record analytics on Spark DataFrames."""
