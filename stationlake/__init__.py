"""Station-feed lakehouse on Spark: bronze ingest, silver typing, gold aggregates."""
