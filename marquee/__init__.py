"""Catalogue analytics on Spark: ingest, combine, derive, profile, model."""
