"""Market-data ingestion and normalisation as Spark DataFrame transforms."""
