"""Whole pipelines, queries and their SQL."""
