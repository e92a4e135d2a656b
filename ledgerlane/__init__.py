"""Retail data quality, enrichment and profit analytics as Spark DataFrame jobs."""
