"""Registered queries with their SQL, and the pipelines."""
