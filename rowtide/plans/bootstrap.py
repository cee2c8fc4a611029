"""First run and restart: snapshot what is missing, then capture changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.progress import all_snapshotted
from rowtide.plans.snapshot import Reader, SourceObject, read_state, run_snapshot
from rowtide.schemas import MESSAGE
from rowtide.sources.tables import read_if_there
from rowtide.streaming.capture import captured_messages, start_capture


def bootstrap(
    spark: SparkSession,
    objects: Sequence[SourceObject],
    read: Reader,
    log: DataFrame,
    folder: str,
    slot: str,
    point: int | None,
    start: int,
    rows_per_wave: int | None = None,
    relations: Callable[[], DataFrame] | None = None,
    pk: DataFrame | None = None,
    roots: DataFrame | None = None,
    **capture,
) -> StreamingQuery:
    """Bring a pipeline up and start capturing from `start`.

    `point` is the consistent point of a slot created for this run; None for a
    slot that existed, whose unfinished objects are then read unpinned.
    Changes before `start` are left out of the log. `capture` goes to
    `start_capture`. `folder` belongs to one slot: a slot created anew needs a new folder, or
    what its predecessor had finished would be skipped.
    """
    state = f"{folder}/state"
    units = spark.createDataFrame([(o.name,) for o in objects], "unit string")
    if point is not None or not all_snapshotted(units, read_state(spark, state)):
        run_snapshot(spark, objects, read, f"{folder}/snapshot", state, point, rows_per_wave)
    from_start = log.filter(F.col("commit_pos").isNull() | (F.col("commit_pos") >= start))
    return start_capture(
        from_start, folder, slot, start, relations, pk=pk, roots=roots, state=state, **capture
    )


def pipeline_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot rows and captured changes of a bootstrap folder, dead letters left out.

    Both carry their position, and a change at or after the snapshot's point
    sorts after the snapshot row: `current_table` of them is the table.
    """
    snapshot = read_if_there(spark, f"{folder}/snapshot", f"{MESSAGE}, error string, part string, topic string")
    rows = snapshot.filter("topic = 'messages'").drop("part", "topic")
    return rows.unionByName(captured_messages(spark, folder))
