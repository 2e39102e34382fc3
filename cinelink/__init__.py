"""cinelink: catalogue ingestion and entity resolution on Spark DataFrames."""
