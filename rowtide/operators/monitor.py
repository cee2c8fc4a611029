"""Counters, gauges and the log-retention alert."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rowtide.functions.lsn import retained_bytes
from rowtide.operators.sizes import broadcast_if_small
from rowtide.schemas import DELETE, INSERT, SNAPSHOT, UPDATE
from rowtide.session import use_checkpoints

RETENTION_WARN_BYTES = 512 * 1024 * 1024
# Rows that one range of keys holds on the mean.
RANGE_ROWS = 10_000
MOST_RANGE_BITS = 32

# Name of the publishing stage of each change operation.
STAGES = {INSERT: "insert", UPDATE: "update", DELETE: "delete"}


def rows_by_table(messages: DataFrame) -> DataFrame:
    """Snapshot rows published, by published name."""
    return (
        messages.filter(F.col("op") == SNAPSHOT)
        .groupBy("table")
        .agg(F.count("*").alias("snapshot_rows"))
    )


def events_by_table_op(messages: DataFrame) -> DataFrame:
    """Change events published, by table and operation."""
    return (
        messages.filter(F.col("op") != SNAPSHOT)
        .groupBy("table", "op")
        .agg(F.count("*").alias("events"))
    )


def errors_by_stage(quarantined: DataFrame) -> DataFrame:
    """Changes that could not be published, by stage.

    Snapshot rows are not counted here, nor are deletes without an old tuple:
    those are dropped with a warning, not failed.
    """
    names = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    return (
        quarantined.filter(F.col("op").isin(*STAGES) & (F.col("error") != "delete_without_old_tuple"))
        .groupBy(F.try_element_at(names, F.col("op")).alias("stage"))
        .agg(F.count("*").alias("errors"))
    )


def rows_by_partition(messages: DataFrame) -> DataFrame:
    """Rows of each physical unit."""
    return messages.groupBy("unit").agg(F.count("*").alias("snapshot_rows"))


def observe_messages(messages: DataFrame, name: str = "published") -> tuple[DataFrame, Observation]:
    """Count messages while they are written, without another pass."""
    seen = Observation(name)
    return (
        messages.observe(
            seen,
            F.count("*").alias("messages"),
            F.count_if(F.col("op") == SNAPSHOT).alias("snapshot_rows"),
            F.count_if(F.col("op") == DELETE).alias("tombstones"),
        ),
        seen,
    )


def slot_health(
    wanted: DataFrame, status: DataFrame, warn_bytes: Column | int = RETENTION_WARN_BYTES
) -> DataFrame:
    """Newest sample of each wanted slot with its gauges.

    A slot without any sample is inactive and in error. `alert` is set when
    the log kept for the slot is strictly above the threshold.
    """
    if isinstance(warn_bytes, int):
        warn_bytes = F.lit(warn_bytes)
    newest = (
        status.groupBy("slot_name")
        .agg(
            F.max_by(
                F.struct("active", "restart_lsn", "confirmed_flush_lsn", "current_wal_lsn"),
                F.col("sampled_at"),
            ).alias("_s")
        )
        .select("slot_name", "_s.*")
    )
    retained = F.when(
        F.col("active").isNotNull(), retained_bytes(F.col("current_wal_lsn"), F.col("restart_lsn"))
    )
    return (
        wanted.select("slot_name")
        .join(newest, "slot_name", "left")
        .withColumn("retained_bytes", retained)
        .select(
            "slot_name",
            F.coalesce(F.col("active").cast("double"), F.lit(0.0)).alias("slot_active"),
            "retained_bytes",
            "restart_lsn",
            "confirmed_flush_lsn",
            F.coalesce(F.col("retained_bytes") > warn_bytes, F.lit(False)).alias("alert"),
            F.when(F.col("active").isNull(), "slot_missing").alias("error"),
        )
    )


def retention_alerts(health: DataFrame) -> DataFrame:
    """Slots that keep more log than allowed."""
    return health.filter("alert")


def snapshot_in_progress(units: DataFrame, state: DataFrame, by: str = "pipeline") -> DataFrame:
    """1 for a pipeline with a unit that was begun and not finished, else 0.

    `units(<by>, unit)`, `state(unit, done, last_pk)` as from `latest_units`.
    """
    return (
        units.join(state, "unit", "left")
        .groupBy(by)
        .agg(
            F.max(F.when(~F.col("done"), 1.0).otherwise(0.0)).alias("snapshot_in_progress")
        )
    )


def snapshot_run_in_progress(units: DataFrame, state: DataFrame, by: str = "pipeline") -> DataFrame:
    """1 for a pipeline from its first begun unit until all are done, else 0.

    Between two units of a run it stays 1, unlike `snapshot_in_progress`.
    """
    begun, done = F.count("done"), F.count_if(F.coalesce("done", F.lit(False)))
    running = (begun > 0) & (done < F.count("*"))
    return (
        units.join(state, "unit", "left")
        .groupBy(by)
        .agg(F.when(running, 1.0).otherwise(0.0).alias("snapshot_in_progress"))
    )


def table_topic_parity(table_keys: DataFrame, topic: DataFrame) -> DataFrame:
    """Rows per table against live keys per table in the topic.

    Both sides are `(table, key)`; counts come from one pass over their union,
    combined on the map side, and so does the number of keys on one side only.
    """
    source = table_keys.select("table", "key", F.lit(1).alias("s"), F.lit(0).alias("t"))
    target = topic.select("table", "key", F.lit(0).alias("s"), F.lit(1).alias("t"))
    per_key = (
        source.unionByName(target)
        .groupBy("table", "key")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    return per_key.groupBy("table").agg(
        F.sum("s").alias("table_rows"),
        F.sum("t").alias("topic_rows"),
        F.count_if(F.col("t") == 0).alias("missing_keys"),
        F.count_if(F.col("s") == 0).alias("extra_keys"),
    ).withColumn("in_parity", F.expr("table_rows = topic_rows AND missing_keys = 0 AND extra_keys = 0"))


def range_bits(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """Bits of the key's hash that make ranges of about `range_rows` rows."""
    return min(MOST_RANGE_BITS, max(0, ceil(log2(max(1, rows) / range_rows))))


def range_digests(rows: DataFrame, bits: int) -> DataFrame:
    """`rows(table, key, value)` as `table, range, rows, digest`: one row a range.

    A range holds the keys whose hash begins with the same `bits` bits, so both
    sides cut alike without knowing each other, and ranges are even. The digest
    is the sum of the rows' hashes: it does not depend on their order, counts
    repeated rows and combines before the shuffle. A NULL key or value differs
    from an empty one.
    """
    row = F.xxhash64(*[x for c in ("key", "value") for x in (F.col(c).isNull(), F.col(c))])
    return (
        rows.withColumn("range", _range_of(bits))
        .groupBy("table", "range")
        .agg(F.count("*").alias("rows"), F.sum(row.cast("decimal(20,0)")).alias("digest"))
    )


def differing_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ranges whose rows differ, as `table, range`; one row a range and side is shuffled.

    A range without rows has no digest, so one on a single side differs.
    """
    sides = source.withColumn("_n", F.lit(1)).unionByName(target.withColumn("_n", F.lit(-1)))
    signed = [F.sum(F.col(c) * F.col("_n")).alias(c) for c in ("rows", "digest")]
    return (
        sides.groupBy("table", "range")
        .agg(*signed, F.sum("_n").alias("_n"))
        .filter("rows <> 0 OR digest <> 0 OR _n <> 0")
        .select("table", "range")
    )


def rows_in_ranges(rows: DataFrame, ranges: DataFrame, bits: int) -> DataFrame:
    """The rows whose keys fall into the given ranges."""
    return rows.withColumn("range", _range_of(bits)).join(ranges, ["table", "range"], "left_semi")


def differing_keys(source: DataFrame, target: DataFrame, bits: int | None = None) -> DataFrame:
    """Keys whose rows differ between two sides, as `table, key, fault`.

    Both sides are `(table, key, value)`, with any number of rows a key. `fault` is
    `missing` (in the source alone), `extra` (in the target alone) or `changed`.
    Equal ranges send one digest a side; only keys of ranges that differ are
    compared, by the count and sum of their rows' hashes, which combine before the
    shuffle. Each side is read twice, the second time for the ranges that differ.
    """
    if bits is None:
        bits = range_bits(source.count())
    differing = differing_ranges(range_digests(source, bits), range_digests(target, bits))
    # Small unless the sides have little in common; used twice.
    use_checkpoints(source.sparkSession)
    ranges = broadcast_if_small(differing.checkpoint())
    row = F.xxhash64(F.col("value").isNull(), "value").cast("decimal(20,0)")
    sides = [
        rows_in_ranges(rows.select("table", "key", "value"), ranges, bits)
        .groupBy("table", "key")
        .agg(F.count("*").alias("n"), F.sum(row).alias("digest"))
        .select("table", "key", F.lit(sign).alias("side"), "n", "digest")
        for rows, sign in ((source, 1), (target, -1))
    ]
    per_key = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("table", "key")
        .agg(
            F.sum("side").alias("side"),
            F.sum(F.col("side") * F.col("n")).alias("n"),
            F.sum(F.col("side") * F.col("digest")).alias("digest"),
        )
    )
    fault = F.when(F.col("side") == 1, "missing").when(F.col("side") == -1, "extra")
    return per_key.filter("side <> 0 OR n <> 0 OR digest <> 0").select(
        "table", "key", F.coalesce(fault, F.lit("changed")).alias("fault")
    )


def _range_of(bits: int) -> Column:
    """The first bits of the key's hash."""
    hashed = F.xxhash64("table", F.col("key").isNull(), "key")
    return F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0).cast("bigint")
