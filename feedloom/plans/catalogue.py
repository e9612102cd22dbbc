"""All queries of the core and their SQL."""

from __future__ import annotations

from feedloom.plans import articles, entities, ingest, instants, texts
from feedloom.plans.texts import flagship

__all__ = ["QUERIES", "SQL", "flagship"]

MODULES = (instants, ingest, entities, texts, articles)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in MODULES for name, q in m.SQL.items()}
