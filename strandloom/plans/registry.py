"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from strandloom.plans import barcode_queries, cell_queries, cluster_queries, density_queries, problems, read_queries, stream_queries

_MODULES = [problems, cluster_queries, density_queries, cell_queries, barcode_queries, read_queries, stream_queries]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
