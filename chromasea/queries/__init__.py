"""Registered queries: one per operator, each with its SQL counterpart."""

from chromasea.queries.base import ORACLES, QUERIES
from chromasea.queries import (  # noqa: F401  (importing registers the queries)
    aggregates, algorithms, expressions, geography, joins, scans, streams, windows,
)

__all__ = ["ORACLES", "QUERIES"]
