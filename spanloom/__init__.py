"""spanloom: a telemetry lake on Spark (logs and traces in, Parquet and a snapshot catalog out)."""
