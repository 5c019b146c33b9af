"""Readers: text, CSV and Parquet files, and the star-schema tables."""
