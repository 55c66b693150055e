"""Structured Streaming jobs (Z1-Z7): ingest to bronze, streaming dedup and
candles, incremental gold."""
