"""Broadcast behind a check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a frame has at most `rows` rows and `size` bytes, as text.

    The look at it stops one row later.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() != "variant"]
    row = F.struct(*[F.col(f"`{c}`") for c in texts]).cast("string")
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(row)).alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a frame for broadcast only once it is known to be small.

    A larger frame is left to a shuffle join, whose skewed keys Spark splits at
    run time.
    """
    return F.broadcast(df) if is_small(df, rows) else df
