"""Readers: CSV, Parquet, keyed tables, message topics, and an ordered fallback."""
