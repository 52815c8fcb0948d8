"""Readers: topics, CSV snapshots, JDBC tables and the driver's Parquet tables."""
