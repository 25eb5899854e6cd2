"""Notice-to-entity analytics on Spark DataFrames."""
