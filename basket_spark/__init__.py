"""Retail analytics on Spark: operators and jobs from DataFrame to DataFrame."""
