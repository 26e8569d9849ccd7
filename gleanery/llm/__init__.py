"""Operators of a training-data pipeline: ten methods, their queries and their SQL."""
