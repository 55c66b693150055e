"""Scans: bronze Parquet, Kafka-shaped records, raw exchange messages and
the adapters that turn the driver's tables into market feeds."""
