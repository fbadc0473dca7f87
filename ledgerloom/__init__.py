"""Snapshot loading, product star schema and data-quality checks as Spark jobs."""
