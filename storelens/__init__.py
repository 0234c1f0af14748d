"""Retail analytics on Spark: bronze, silver and gold layers, measures, reports and data-quality jobs."""
