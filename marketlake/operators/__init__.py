"""DataFrame -> DataFrame operators: ingest, staging, aggregation, windows."""
