"""Progress: unit state, start positions, safe positions, the boundary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.json_text import quote, rfc3339
from rowtide.functions.lsn import parse_lsn
from rowtide.operators.sizes import is_small

CHECKPOINT_KEY = "checkpoint"
_RFC3339 = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:\d\d)$"


def latest_units(state_log: DataFrame) -> DataFrame:
    """Newest state of each unit: `unit, done, last_pk`.

    The order is that of `seq`, where the log has one: clocks of different
    drivers may disagree.
    """
    order = ["seq"] if "seq" in state_log.columns else []
    newest = F.max_by(F.struct("done", "last_pk"), F.struct(*order, "saved_at", "done"))
    return state_log.groupBy("unit").agg(newest.alias("_s")).select("unit", "_s.*")


def pending_units(units: DataFrame, state: DataFrame) -> DataFrame:
    """Units still to read, with the cursor to continue from."""
    return units.join(state, "unit", "left").filter(~F.coalesce("done", F.lit(False))).drop("done")


def skip_finished(units: DataFrame, state: DataFrame) -> DataFrame:
    """Units without a finished state."""
    return units.join(state.filter("done").select("unit"), "unit", "left_anti")


def all_snapshotted(objects: DataFrame, state: DataFrame) -> bool:
    """True when every configured object, views included, is done."""
    return skip_finished(objects, state).isEmpty()


def load_checkpoint(topic: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last valid checkpoint of a state topic: `confirmed_lsn, snapshots`.

    Other keys, empty values and values that are not a checkpoint are passed
    over, whatever came before stays. Always partition 0. `by` reads several
    topics at once. A missing `snapshots` is an empty map.
    """
    shape = (
        "confirmed_lsn string, snapshots map<string,struct<done:string,last_pk:string>>, "
        "updated_at string"
    )
    parsed = topic.filter(
        (F.col("partition") == 0) & (F.col("key") == CHECKPOINT_KEY) & (F.length("value") > 0)
    ).withColumn("_v", F.try_parse_json("value"))
    kind = F.schema_of_variant("_v")
    lsn_kind = F.schema_of_variant(F.variant_get("_v", "$.confirmed_lsn", "variant"))
    units_kind = F.schema_of_variant(F.variant_get("_v", "$.snapshots", "variant"))
    is_object = kind.startswith("OBJECT")
    well_typed = (
        F.coalesce(lsn_kind, F.lit("VOID")).isin("STRING", "VOID")
        & F.coalesce(units_kind.startswith("OBJECT") | (units_kind == "VOID"), F.lit(True))
    )
    read = F.from_json("value", shape)
    units = F.map_values(F.variant_get("_v", "$.snapshots", "map<string,variant>"))

    def unit_ok(unit: Column) -> Column:
        is_unit = F.schema_of_variant(unit).startswith("OBJECT")
        flag = F.schema_of_variant(F.variant_get(unit, "$.done", "variant"))
        flag_ok = F.coalesce(flag, F.lit("VOID")).isin("BOOLEAN", "VOID")
        return F.coalesce(unit.isNull() | F.is_variant_null(unit) | (is_unit & flag_ok), F.lit(True))

    stamp = F.variant_get("_v", "$.updated_at", "variant")
    stamp_text = F.try_variant_get("_v", "$.updated_at", "string")
    stamp_ok = F.coalesce(
        stamp.isNull()
        | F.is_variant_null(stamp)
        | (
            (F.schema_of_variant(stamp) == "STRING")
            & stamp_text.rlike(_RFC3339)
            & stamp_text.try_cast("timestamp").isNotNull()
        ),
        F.lit(True),
    )
    units_ok = F.when(
        units_kind.startswith("OBJECT"), F.coalesce(F.forall(units, unit_ok), F.lit(True))
    ).otherwise(F.lit(True))
    flags_ok = F.when(is_object & well_typed, units_ok & stamp_ok).otherwise(F.lit(True))
    valid = parsed.filter(
        F.col("_v").isNotNull() & ((kind == "VOID") | (is_object & well_typed & flags_ok))
    )
    newest = F.max_by(read, F.col("offset"))
    none = F.create_map().cast("map<string,struct<done:string,last_pk:string>>")
    unit_state = F.transform_values(
        F.coalesce(F.col("_c.snapshots"), none),
        lambda _, s: F.struct(
            F.coalesce(s["done"] == "true", F.lit(False)).alias("done"), s["last_pk"].alias("last_pk")
        ),
    )
    return (
        valid.groupBy(*by)
        .agg(newest.alias("_c"))
        .filter("_c IS NOT NULL")
        .select(
            *by,
            F.nullif(F.col("_c.confirmed_lsn"), F.lit("")).alias("confirmed_lsn"),
            unit_state.alias("snapshots"),
            F.col("_c.updated_at").alias("updated_at"),
        )
    )


def checkpoint_units(checkpoint: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unit states of a checkpoint, one row per unit."""
    return checkpoint.select(*by, F.explode("snapshots").alias("unit", "_s")).select(
        *by, "unit", "_s.done", "_s.last_pk"
    )


def checkpoint_record(
    units: DataFrame, confirmed_lsn: str | None, updated_at: Column | None = None
) -> DataFrame:
    """The topic record of a checkpoint: always key `checkpoint`, partition 0.

    The record holds every configured unit by its format, so `units` is a
    pipeline's unit list, not data.
    """
    stamp = F.current_timestamp() if updated_at is None else updated_at
    cursor = F.when(F.col("last_pk").isNotNull(), F.concat(F.lit(',"last_pk":'), F.col("last_pk")))
    entry = F.concat(
        quote(F.col("unit")),
        F.lit(':{"done":'),
        F.col("done").cast("string"),
        F.coalesce(cursor, F.lit("")),
        F.lit("}"),
    )
    lsn = "" if confirmed_lsn is None else f'"confirmed_lsn":"{confirmed_lsn}",'
    body = units.agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("units"))
    return body.select(
        F.lit(0).alias("partition"),
        F.lit(CHECKPOINT_KEY).alias("key"),
        F.concat(
            F.lit("{" + lsn + '"snapshots":{'),
            F.col("units"),
            F.lit('},"updated_at":"'),
            rfc3339(stamp),
            F.lit('"}'),
        ).alias("value"),
    )


def start_positions(
    slots: DataFrame, checkpoints: DataFrame, created: DataFrame, bind_to_slot: bool = False
) -> DataFrame:
    """Where each slot's stream starts: `slot_name, start_lsn, start_pos`.

    The checkpoint wins, then the consistent point of a slot created now, then
    the slot's own confirmed position. With `bind_to_slot` a checkpoint left by
    an earlier slot of the same name does not win over the new slot's point.
    """
    order = ["confirmed_lsn", "consistent_point", "confirmed_flush_lsn"]
    if bind_to_slot:
        order = ["consistent_point", "confirmed_lsn", "confirmed_flush_lsn"]
    return (
        slots.select("slot_name", "confirmed_flush_lsn")
        .join(checkpoints.select("slot_name", "confirmed_lsn"), "slot_name", "left")
        .join(created.select("slot_name", "consistent_point"), "slot_name", "left")
        .select(
            "slot_name",
            F.coalesce(*order).alias("start_lsn"),
        )
        .withColumn("start_pos", parse_lsn(F.col("start_lsn")))
    )


def bootstrap_decision(objects: DataFrame, state: DataFrame, created: DataFrame) -> DataFrame:
    """What each slot does first: `slot_name, action, unfinished`.

    A slot created now takes a snapshot at its consistent point; an older one
    with unfinished objects reads the rest without one; otherwise it streams.
    `objects(slot_name, unit)`, `state(slot_name, unit, done)`. What an earlier
    slot of the same name had finished does not count for a new one: its rows
    and the new slot's changes would not meet.
    """
    is_new = created.select("slot_name", F.lit(True).alias("is_new"))
    done = state.filter("done").select("slot_name", "unit", F.lit(True).alias("done"))
    return (
        objects.join(is_new, "slot_name", "left")
        .join(done, ["slot_name", "unit"], "left")
        .groupBy("slot_name")
        .agg(
            F.coalesce(F.bool_or("is_new"), F.lit(False)).alias("is_new"),
            F.count_if(F.coalesce(F.col("is_new"), F.lit(False)) | F.col("done").isNull()).alias(
                "unfinished"
            ),
        )
        .select(
            "slot_name",
            F.when(F.col("is_new"), "pinned_snapshot")
            .when(F.col("unfinished") > 0, "recovery_snapshot")
            .otherwise("stream")
            .alias("action"),
            "unfinished",
        )
    )


def safe_position(log: DataFrame, starts: DataFrame, monotone: bool = False) -> DataFrame:
    """Position a slot may confirm after its log: `slot_name, safe_pos, last_commit`.

    In arrival order the position rises to each message's position, and falls
    back to the commit's own when a higher commit arrives. So the highest
    commit's first arrival decides: the result is the greater of it and of the
    positions that arrived after it. Two aggregates, no sort over the log.

    `starts(slot_name, start_pos[, last_commit])`; the output feeds the next
    part of a log. `monotone` reports the highest position ever reached.
    """
    if "last_commit" not in starts.columns:
        starts = starts.withColumn("last_commit", F.col("start_pos"))
    is_commit = F.col("kind") == "C"
    seen = F.when(F.col("kind") == "K", F.col("end_pos")).otherwise(F.col("wal_pos"))
    rows = log.select(
        "slot_name",
        "arrival",
        seen.alias("seen"),
        F.when(is_commit, F.col("commit_pos")).alias("commit"),
    )
    top_commit = F.max(F.struct("commit", (-F.col("arrival")).alias("back")))
    marks = (
        starts.join(rows.groupBy("slot_name").agg(top_commit.alias("top")), "slot_name")
        .select(
            "slot_name",
            F.when(F.col("top.commit") > F.col("last_commit"), F.col("top")).alias("top"),
        )
    )
    # One row per slot, of which there are no more than in `starts`.
    if is_small(starts):
        marks = F.broadcast(marks)
    counts = F.col("top").isNull() | (F.col("arrival") > -F.col("top.back"))
    reached = (
        rows.join(marks, "slot_name")
        .groupBy("slot_name")
        .agg(
            F.max("top.commit").alias("commit"),
            F.max("seen" if monotone else F.when(counts, F.col("seen"))).alias("seen"),
        )
    )
    base = F.coalesce("commit", "start_pos")
    if monotone:
        base = F.greatest("commit", "start_pos")
    return starts.join(reached, "slot_name", "left").select(
        "slot_name",
        F.greatest(base, "seen").alias("safe_pos"),
        F.greatest("commit", "last_commit").alias("last_commit"),
    )


def with_boundary(snapshot: DataFrame, changes: DataFrame, point: int | Column) -> DataFrame:
    """Snapshot rows and the changes that are not in them: no gap, no overlap.

    The cut is by commit position: a transaction that began before the point
    but committed after it is not in the snapshot.
    """
    later = changes.filter(F.col("commit_pos") >= point)
    return snapshot.unionByName(later, allowMissingColumns=True)
