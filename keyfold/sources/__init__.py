"""Event logs in and out of Spark."""
