"""Funding-notice analytics as PySpark DataFrame and Structured Streaming jobs."""
