"""Bulk loads of Parquet tables into a PostgreSQL-style target, as Spark jobs."""
