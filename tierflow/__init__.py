"""Layered analytics on Spark: landing, staging, dimensions, aggregates, quality and metrics."""
