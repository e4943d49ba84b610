"""Batch analytics for developer-activity events, written as plain Spark jobs."""
