"""Query, ingestion, change-data and file-layout work on Spark DataFrames."""
