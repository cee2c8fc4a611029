"""The initial snapshot as a resumable job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from rowtide.functions.keyset import read_cursor
from rowtide.operators.messages import MESSAGE_COLUMNS
from rowtide.operators.progress import latest_units
from rowtide.operators.snapshot import (
    between,
    range_units,
    snapshot_partitioned,
    snapshot_table,
    snapshot_view,
)
from rowtide.schemas import STORED_STATE
from rowtide.sources.sinks import append_state, write_message_log
from rowtide.sources.tables import read_if_there

# Children of one root that a single job reads.
CHILDREN_PER_JOB = 64

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class SourceObject:
    """A configured object; `children` are set for a partitioned root."""

    name: str
    kind: str
    pk: tuple[str, ...] = ()
    children: tuple[str, ...] = field(default=())


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Newest unit states; none where nothing was saved yet."""
    return latest_units(read_if_there(spark, path, STORED_STATE))


def run_snapshot(
    spark: SparkSession,
    objects: Sequence[SourceObject],
    read: Reader,
    out: str,
    state: str,
    point: int | None = None,
    rows_per_wave: int | None = None,
) -> None:
    """Write the messages of every unfinished object and record progress.

    A run that stops part-way goes on where it stopped when it is run again.
    Objects are read one after the other, each by all executors. With
    `rows_per_wave` a table is written in key ranges of that many rows and its
    cursor saved after each; otherwise in one job. Output folders are named by
    unit and wave, so repeating a wave whose progress was not saved replaces
    what it had written.
    """
    saved = {r.unit: r for r in read_state(spark, state).toLocalIterator()}
    for obj in objects:
        if _done(saved, obj.name):
            continue
        if obj.kind == "part_root":
            _root(spark, obj, read, out, state, point, saved, rows_per_wave)
        elif obj.pk:
            cursor = saved[obj.name].last_pk if obj.name in saved else None
            _table(spark, obj, obj.name, read, out, state, point, cursor, rows_per_wave)
        else:
            _write(snapshot_view(read(obj.name), obj.name, position=point), out, obj.name, None)
            _save(spark, state, [(obj.name, True, None)])


def _root(spark, obj, read, out, state, point, saved, rows_per_wave) -> None:
    pending = [c for c in obj.children if not _done(saved, c)]
    begun = [c for c in pending if c in saved and saved[c].last_pk]
    if rows_per_wave is not None or begun:
        for child in pending:
            cursor = saved[child].last_pk if child in saved else None
            _table(spark, obj, child, read, out, state, point, cursor, rows_per_wave)
    else:
        for i in range(0, len(pending), CHILDREN_PER_JOB):
            group = pending[i : i + CHILDREN_PER_JOB]
            rows = {c: read(c) for c in group}
            messages = snapshot_partitioned(spark, rows, obj.name, obj.pk, point)
            # Named by its first child, which stays the same on a repeat.
            _write(messages, out, group[0], None)
            _save(spark, state, [(c, True, None) for c in group])
    _save(spark, state, [(obj.name, True, None)])


def _table(spark, obj, unit, read, out, state, point, cursor, rows_per_wave) -> None:
    rows = read(unit)
    start = read_cursor(cursor, rows, obj.pk)
    rest = rows
    ends: list[str | None] = [None]
    if rows_per_wave is not None:
        if start is not None:
            rest = between(rows, obj.pk, start, None)
        units = range_units(rest, obj.pk, rows_per_wave).orderBy("unit_no")
        ends = [r.end for r in units.toLocalIterator()] or [None]
    for end in ends:
        stop = read_cursor(end, rows, obj.pk)
        messages = snapshot_table(rows, obj.name, obj.pk, point, start, stop)
        _write(messages, out, unit, cursor)
        _save(spark, state, [(unit, end is None, end)])
        start, cursor = stop, end


def _done(saved: dict, unit: str) -> bool:
    return unit in saved and bool(saved[unit].done)


def _write(messages: DataFrame, out: str, unit: str, cursor: str | None) -> None:
    """One folder per unit and the cursor it was read from."""
    folder = md5(f"{unit}\n{cursor or ''}".encode()).hexdigest()
    write_message_log(messages.select(*MESSAGE_COLUMNS, "error"), f"{out}/part={folder}")


def _save(spark: SparkSession, state: str, rows: list[tuple[str, bool, str | None]]) -> None:
    append_state(spark.createDataFrame(rows, "unit string, done boolean, last_pk string"), state)
