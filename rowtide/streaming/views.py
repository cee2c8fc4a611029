"""Views read again at an interval."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.messages import MESSAGE_COLUMNS
from rowtide.operators.snapshot import refresh_views
from rowtide.sources.sinks import write_message_log
from rowtide.sources.tables import pin_cycle, read_cycle

log = logging.getLogger(__name__)

Views = Mapping[str, Callable[[], DataFrame]]
# Views over tables, which they get by name.
PinnedViews = Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]]


def refresh_once(views: Views, out: str, cycle_id: int) -> bool:
    """One cycle: all views or none. A failure is reported, not raised."""
    try:
        messages = refresh_views({name: read() for name, read in views.items()}, cycle_id)
        if messages is not None:
            write_message_log(
                messages.select(*MESSAGE_COLUMNS, "error"), f"{out}/cycle={cycle_id}"
            )
        return True
    except Exception:
        log.exception("view refresh %s failed, the next cycle starts afresh", cycle_id)
        return False


def pinned_views(
    spark: SparkSession, tables: Mapping[str, str], views: PinnedViews, folder: str, cycle_id: int
) -> Views:
    """The views of one cycle, all over the same read point of their tables.

    `tables` are parquet paths by name. The point is taken when the first view is
    read; a repeat of the cycle finds it again under `folder`.
    """

    def read(name: str) -> DataFrame:
        pin_cycle(spark, tables, folder, cycle_id)
        return read_cycle(spark, folder, cycle_id, name)

    return {name: partial(view, read) for name, view in views.items()}


def start_pinned_refresh(
    spark: SparkSession,
    tables: Mapping[str, str],
    views: PinnedViews,
    folder: str,
    out: str,
    seconds: int,
    checkpoint: str,
) -> StreamingQuery | None:
    """`start_refresh` with one read point for all views of a cycle."""

    def cycle_views(cycle: int) -> Views:
        return pinned_views(spark, tables, views, folder, cycle)

    return _every(spark, cycle_views, out, seconds, checkpoint) if views else None


def start_refresh(
    spark: SparkSession, views: Views, out: str, seconds: int, checkpoint: str
) -> StreamingQuery | None:
    """Refresh every `seconds`; None when that is not positive or there are no views."""
    return _every(spark, lambda _: views, out, seconds, checkpoint) if views else None


def _every(
    spark: SparkSession,
    cycle_views: Callable[[int], Views],
    out: str,
    seconds: int,
    checkpoint: str,
) -> StreamingQuery | None:
    if seconds <= 0:
        return None
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda _, cycle: refresh_once(cycle_views(cycle), out, cycle))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )
