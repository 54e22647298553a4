"""Sources (driver fixtures, JSON payloads, Parquet) and sinks."""
