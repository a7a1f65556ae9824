"""Retail ingest, star-schema mart and customer features as Spark jobs."""
