"""Interval and event-pair analytics on call records, as plain Spark DataFrame jobs."""
