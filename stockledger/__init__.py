"""Stock, purchasing and billing analytics on Spark DataFrames."""
