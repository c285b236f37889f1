"""Dimensional lakehouse jobs on Spark: sources, cleaning, keys, dimensions, facts, streams and gold tables."""
