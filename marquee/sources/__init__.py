"""Landed JSON pages, parquet tables and stored models."""
