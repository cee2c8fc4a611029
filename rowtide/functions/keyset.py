"""Keyset predicates and cursors over a composite primary key."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowtide.functions.json_text import json_scalar


def after(df: DataFrame, pk: Sequence[str], cursor: Sequence) -> Column:
    """Rows whose key sorts after `cursor`.

    Written as `a > x OR (a = x AND b > y)`: unlike a comparison of structs,
    this form is pushed to the scan. The leading bound is repeated on its own
    so that a source that only understands conjunctions can prune too.
    """
    return _beyond(df, pk, cursor, strict=True, forward=True)


def up_to(df: DataFrame, pk: Sequence[str], cursor: Sequence) -> Column:
    """Rows whose key sorts at or before `cursor`."""
    return _beyond(df, pk, cursor, strict=False, forward=False)


def _beyond(
    df: DataFrame, pk: Sequence[str], cursor: Sequence, strict: bool, forward: bool
) -> Column:
    values = _typed(df, pk, cursor)
    columns = [df[f"`{c}`"] for c in pk]

    def beyond(col: Column, val: Column) -> Column:
        return col > val if forward else col < val

    branches = []
    for i, (col, val) in enumerate(zip(columns, values)):
        equal_so_far = [c == v for c, v in zip(columns[:i], values[:i])]
        branches.append(reduce(Column.__and__, [*equal_so_far, beyond(col, val)]))
    if not strict:
        branches.append(reduce(Column.__and__, [c == v for c, v in zip(columns, values)]))
    condition = reduce(Column.__or__, branches)
    if len(columns) > 1:
        lead = columns[0] >= values[0] if forward else columns[0] <= values[0]
        condition = lead & condition
    return condition


def _typed(df: DataFrame, pk: Sequence[str], cursor: Sequence) -> list[Column]:
    if len(pk) != len(cursor):
        raise ValueError(f"cursor {cursor!r} does not fit key {list(pk)}")

    def typed(value, dtype: T.DataType) -> Column:
        # A cursor holds binary keys as base64 text.
        if isinstance(dtype, T.BinaryType) and isinstance(value, str):
            return F.unbase64(F.lit(value))
        return F.lit(value).cast(dtype)

    return [typed(v, df.schema[c].dataType) for c, v in zip(pk, cursor)]


def cursor_json(df: DataFrame, pk: Sequence[str]) -> Column:
    """Cursor of a row: its key values as a JSON array, in key order."""
    parts: list[Column] = []
    for i, name in enumerate(pk):
        parts += [
            F.lit("," if i else "["),
            F.coalesce(json_scalar(df[f"`{name}`"], df.schema[name].dataType), F.lit("null")),
        ]
    return F.concat(*parts, F.lit("]"))


def read_cursor(text: str | None, df: DataFrame, pk: Sequence[str]) -> list | None:
    """Key values of a saved cursor, as text where a float would lose digits."""
    if not text:
        return None
    values = json.loads(text, parse_float=str, parse_int=str)
    if len(values) != len(pk):
        raise ValueError(f"cursor {text} does not fit key {list(pk)}")
    zoned = [isinstance(df.schema[c].dataType, T.TimestampNTZType) for c in pk]
    return [v.rstrip("Z") if z and isinstance(v, str) else v for v, z in zip(values, zoned)]


def last_cursor(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: the greatest key of the frame as a cursor."""
    top = df.agg(F.max(F.struct(*[F.col(f"`{c}`") for c in pk])).alias("top"))
    top = top.select("top.*")
    return top.select(
        F.when(F.col(f"`{pk[0]}`").isNotNull(), cursor_json(top, pk)).alias("last_pk")
    )
