"""rowfold: Spark operators for exact, resumable, de-duplicating ingestion and the analytics around it."""
