"""One query per inventory item over the given tables, each with an independent SQL statement."""

from __future__ import annotations

from coverage_queries.registry import ORACLES, QUERIES
from coverage_queries import (  # noqa: F401  (importing registers the queries)
    q_checks,
    q_final,
    q_functions,
    q_grids,
    q_joins,
    q_sources,
    q_summaries,
    q_time,
)

__all__ = ["ORACLES", "QUERIES"]
