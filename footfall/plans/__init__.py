"""Whole jobs: the daily refresh, and the queries with their checks."""
