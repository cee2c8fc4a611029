"""Object names and partition routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def schema_of(qualified: Column) -> Column:
    """Part before the first dot; NULL for a name that is not `schema.name`."""
    return F.when(_well_formed(qualified), F.split(qualified, r"\.", 2)[0])


def name_of(qualified: Column) -> Column:
    """Part after the first dot, further dots included."""
    return F.when(_well_formed(qualified), F.split(qualified, r"\.", 2)[1])


def _well_formed(qualified: Column) -> Column:
    return qualified.rlike(r"(?s)^[^.]+\..+$")


def route(value: Column, ranges: Sequence[tuple[str, object, object]], default: str) -> Column:
    """Child partition of a value: half-open ranges, `default` for the rest.

    Bounds given as text are read by Spark in the session's time zone, as the
    database reads them in its own.
    """
    result = None
    for child, start, end in ranges:
        inside = (value >= F.lit(start)) & (value < F.lit(end))
        result = F.when(inside, child) if result is None else result.when(inside, child)
    return F.lit(default) if result is None else result.otherwise(F.lit(default))
