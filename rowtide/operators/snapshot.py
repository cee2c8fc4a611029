"""Snapshots: scans, keyset pages, ranges and view refreshes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowtide.functions.keyset import after, cursor_json, up_to
from rowtide.operators.messages import row_messages
from rowtide.operators.sizes import broadcast_if_small
from rowtide.schemas import MESSAGE
from rowtide.session import use_checkpoints

FETCH_SIZE = 1000
# Keys of one slice of a distributed rank; a slice is sorted by one task.
SLICE_ROWS = 10_000_000


def between(
    rows: DataFrame, pk: Sequence[str], start: Sequence | None, end: Sequence | None
) -> DataFrame:
    """Rows with `start < key <= end`; an open side is None."""
    if start is not None:
        rows = rows.filter(after(rows, pk, start))
    if end is not None:
        rows = rows.filter(up_to(rows, pk, end))
    return rows


def snapshot_table(
    rows: DataFrame,
    table: str,
    pk: Sequence[str],
    position: int | None = None,
    start: Sequence | None = None,
    end: Sequence | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Messages of a keyed table, or of the part of it between two cursors.

    `position` None is an unpinned read: its rows may overlap or miss changes
    around it, which `consistent` tells the reader.
    """
    messages = row_messages(between(rows, pk, start, end), table, pk, position, ts)
    return messages.withColumn("consistent", F.lit(position is not None))


def snapshot_partitioned(
    spark: SparkSession,
    children: Mapping[str, DataFrame],
    root: str,
    pk: Sequence[str],
    position: int | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Messages of all children under the root's name; `unit` is the child.

    One job reads the children in parallel. A root without children has no
    rows.
    """
    parts = [
        snapshot_table(rows, root, pk, position, ts=ts).withColumn("unit", F.lit(name))
        for name, rows in children.items()
    ]
    if not parts:
        ddl = MESSAGE + ", error string, consistent boolean, unit string"
        return spark.createDataFrame([], ddl)
    return reduce(DataFrame.unionByName, parts)


def snapshot_view(
    rows: DataFrame,
    view: str,
    key: Sequence[str] = (),
    position: int | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Messages of a view, read whole. Its rows share the key `{}` unless
    columns that identify them are named."""
    return row_messages(rows, view, key, position, ts).withColumn(
        "consistent", F.lit(position is not None)
    )


def refresh_views(
    views: Mapping[str, DataFrame], cycle_id: int, ts: Column | None = None
) -> DataFrame | None:
    """One refresh cycle: every view again in full, as one plan.

    A view that fails therefore fails the whole cycle and the next one starts
    afresh. Rows that vanished get no tombstone. None without views.
    """
    parts = [
        snapshot_view(rows, name, ts=ts).withColumn("cycle_id", F.lit(cycle_id))
        for name, rows in views.items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def keyset_page(
    rows: DataFrame, pk: Sequence[str], cursor: Sequence | None, size: int = FETCH_SIZE
) -> DataFrame:
    """The `size` rows that follow the cursor in key order."""
    if size < 1:
        raise ValueError("page size must be positive")
    return between(rows, pk, cursor, None).orderBy(*pk).limit(size)


def page_plan(counts: DataFrame, size: Column | int) -> DataFrame:
    """Pages of each unit of `counts(unit, rows)`: a page shorter than `size`
    ends the unit, so a full multiple has an empty last page."""
    size = F.lit(size) if isinstance(size, int) else size
    return counts.withColumn(
        "pages", (F.floor(F.col("rows") / size) + 1).cast("bigint")
    ).withColumn("last_page_rows", (F.col("rows") % size).cast("bigint"))


def range_pages(rows: DataFrame, pk: Sequence[str], pages: int) -> DataFrame:
    """All rows as disjoint, sorted key ranges, one per partition.

    The ranges split on the whole key, so one hot leading value is spread too.
    """
    return rows.repartitionByRange(pages, *pk).sortWithinPartitions(*pk)


def range_units(rows: DataFrame, pk: Sequence[str], rows_per_unit: int) -> DataFrame:
    """Split a large unit into key ranges: `unit_no, start, end, rows`.

    `start` (exclusive) and `end` (inclusive) are cursors; the first range is
    open below and the last above. Only key columns are shuffled.
    """
    if rows_per_unit < 1:
        raise ValueError("rows_per_unit must be positive")
    keys = rows.select(*[F.col(f"`{c}`") for c in pk])
    units = max(1, ceil(keys.count() / rows_per_unit))
    ranged = keys.repartitionByRange(units, *pk).withColumn("_slice", F.spark_partition_id())
    tops = (
        ranged.groupBy("_slice")
        .agg(F.max(F.struct(*pk)).alias("_top"), F.count("*").alias("rows"))
        .select("_slice", "rows", "_top.*")
    )
    cursors = tops.select("_slice", "rows", cursor_json(tops, pk).alias("end"))
    # One row per range from here on.
    in_order = Window.orderBy("_slice")
    return cursors.select(
        F.row_number().over(in_order).alias("unit_no"),
        F.lag("end").over(in_order).alias("start"),
        F.when(F.lead("end").over(in_order).isNotNull(), F.col("end")).alias("end"),
        "rows",
    )


def page_cursors(
    rows: DataFrame, pk: Sequence[str], size: int = FETCH_SIZE, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The cursor saved after every full page: `page_no, last_pk`.

    The pages are those a sequence of `keyset_page` reads would give, found
    without reading one after the other: keys are split into ranges, ranked
    inside their range and moved on by the rows of the ranges before it.
    """
    if size < 1:
        raise ValueError("page size must be positive")
    use_checkpoints(rows.sparkSession)
    keys = rows.select(*[F.col(f"`{c}`") for c in pk])
    slices = max(1, ceil(keys.count() / slice_rows))
    # The checkpoint fixes which range a key fell into, for both uses below.
    ranged = (
        keys.repartitionByRange(slices, *pk)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    counts = ranged.groupBy("_slice").agg(F.count("*").alias("n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy(*pk))
    ranked = (
        ranged.withColumn("_rank", rank)
        .join(broadcast_if_small(offsets), "_slice")
        .withColumn("_rank", F.col("_rank") + F.col("offset"))
        .filter(F.col("_rank") % size == 0)
    )
    return ranked.select(
        (F.col("_rank") / size).cast("bigint").alias("page_no"),
        cursor_json(ranked, pk).alias("last_pk"),
    )
