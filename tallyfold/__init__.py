"""Batch extracts to checked, historised tables, written as Spark jobs."""
