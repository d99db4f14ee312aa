"""Query and data processing for linked documents on Spark DataFrames."""
