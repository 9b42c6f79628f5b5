"""Readers at the edge of the pipeline: parquet tables, landed tag
products and partner CSV files."""
