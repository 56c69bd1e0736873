"""Operators over catalogs, candidates, facts and verdicts."""
