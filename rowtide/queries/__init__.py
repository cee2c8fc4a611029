"""Every operator as a query over the given tables, beside equivalent SQL."""

from rowtide.queries import (
    catalog,
    changes,
    messages,
    monitoring,
    progress,
    snapshots,
    state,
    streams,
)
from rowtide.queries.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "catalog",
    "changes",
    "messages",
    "monitoring",
    "progress",
    "snapshots",
    "state",
    "streams",
]
