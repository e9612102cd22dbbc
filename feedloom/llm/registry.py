"""What ``__spark_entry__`` adds when this package can be imported."""

from __future__ import annotations

from feedloom.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
