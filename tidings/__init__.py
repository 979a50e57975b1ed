"""News-page ingestion as Spark jobs."""
