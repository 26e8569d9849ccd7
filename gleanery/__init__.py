"""Retrieval-corpus preparation, search and evaluation as Spark DataFrame jobs."""
