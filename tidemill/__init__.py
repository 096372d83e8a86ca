"""tidemill: batch and incremental ETL, star-schema and reporting operators on Spark DataFrames."""
