"""Packet sources: CSV (batch / stream), JSON / Kafka messages, Parquet archive,
and the adapter that derives packets from the test ``events`` table."""
