"""The registered queries and the SQL they are checked against."""

from __future__ import annotations

from .plans import exon_queries, file_queries, mapping_queries, queries

QUERIES: dict = {**queries.QUERIES, **exon_queries.QUERIES, **file_queries.QUERIES, **mapping_queries.QUERIES}
ORACLES: dict[str, str] = {**queries.ORACLES, **exon_queries.ORACLES, **file_queries.ORACLES, **mapping_queries.ORACLES}
