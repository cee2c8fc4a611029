"""Message assembly: keys, values, headers, quarantine, compaction."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.json_text import headers, json_object, unencodable
from rowtide.functions.lsn import format_lsn
from rowtide.schemas import SNAPSHOT

MESSAGE_COLUMNS = ("table", "op", "key", "value", "commit_pos", "ord", "ts", "lsn")


def publish_time() -> Column:
    """Wall-clock milliseconds, as stamped on a message when it is published."""
    return F.unix_millis(F.current_timestamp())


def row_messages(
    rows: DataFrame,
    table: str | Column,
    pk: Sequence[str] = (),
    position: int | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Snapshot messages of a frame: one per row, op `r`.

    `pk` empty means a view, whose rows all have the key `{}`. `position` is
    the point the snapshot was taken at; NULL for an unpinned one. `error` is
    set for rows that JSON cannot carry.
    """
    label = F.lit(table) if isinstance(table, str) else table
    bad = unencodable(rows)
    return rows.select(
        label.alias("table"),
        F.lit(SNAPSHOT).alias("op"),
        json_object(rows, list(pk)).alias("key"),
        json_object(rows, rows.columns).alias("value"),
        F.lit(position).cast("bigint").alias("commit_pos"),
        F.lit(-1).cast("bigint").alias("ord"),
        (publish_time() if ts is None else ts).alias("ts"),
        F.lit(None).cast("string").alias("lsn"),
        F.when(bad, "unencodable_float").alias("error"),
    )


def split_quarantine(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publishable messages, dead letters).

    Dead letters keep whatever key, value and header columns could be built.
    """
    return (
        messages.filter("error IS NULL").select(*MESSAGE_COLUMNS),
        messages.filter("error IS NOT NULL"),
    )


def kafka_columns() -> tuple[Column, Column, Column]:
    """`key, value, headers` of a message as the Kafka sink wants them.

    Changes carry the `lsn` header, snapshot rows do not.
    """
    lsn = F.coalesce("lsn", F.when(F.col("ord") >= 0, format_lsn(F.col("commit_pos"))))
    return (
        F.col("key"),
        F.col("value"),
        headers(F.col("table"), F.col("op"), F.col("ts"), lsn).alias("headers"),
    )


def kafka_layout(messages: DataFrame) -> DataFrame:
    """Messages in Kafka's layout."""
    return messages.select(*kafka_columns())


def ordered_by_key(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread by key, in log order inside a key.

    View rows all share the key `{}`; they have no order to keep, so they are
    spread over all partitions by their content instead.
    """
    spread = F.when(F.col("key") == "{}", F.xxhash64("value"))
    target = [F.col("table"), F.col("key"), spread]
    spread_out = (
        messages.repartition(partitions, *target) if partitions else messages.repartition(*target)
    )
    return spread_out.sortWithinPartitions("table", "key", "commit_pos", "ord")


def position_waves(
    messages: DataFrame, rows_per_wave: int
) -> list[tuple[int | None, int | None]]:
    """Cut messages into position ranges `(after, up to]` of about equal size.

    Published one after the other they keep the order of every key, and a hot
    key, which cannot be split inside a wave, is no longer than its share of
    one. The cuts need not be exact: the ranges are disjoint and complete.
    """
    waves = ceil(messages.count() / rows_per_wave)
    if waves <= 1:
        return [(None, None)]
    shares = [i / waves for i in range(1, waves)]
    cuts = messages.agg(F.percentile_approx("commit_pos", shares, 10 * waves)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    return list(zip(bounds, bounds[1:]))


def in_wave(wave: tuple[int | None, int | None]) -> Column:
    """Messages of a wave; those without a position belong to the first."""
    after, up_to = wave
    position = F.col("commit_pos")
    inside = F.lit(True) if up_to is None else position <= up_to
    if after is None:
        return inside if up_to is None else inside | position.isNull()
    return inside & (position > after)


def compact(topic: DataFrame, keys: Sequence[str] = ("key",), order: str = "offset") -> DataFrame:
    """Log compaction: the newest record of each key, tombstones included.

    `max_by` combines on the map side, so a hot key reaches the shuffle as one
    row per input partition.
    """
    rest = [c for c in topic.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(order))
    return topic.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")
