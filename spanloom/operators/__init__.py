"""DataFrame to DataFrame steps of ingest."""
