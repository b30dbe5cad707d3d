"""Retail sales pipeline on Spark: clean, collapse, star schema, merge, export."""
