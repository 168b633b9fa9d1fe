"""Document ingestion and retrieval jobs on Spark: every operation takes DataFrames and gives a DataFrame."""
