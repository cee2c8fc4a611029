"""Change decoding: log messages plus relation metadata to keyed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowtide.functions.lsn import format_lsn, parse_lsn
from rowtide.functions.pgtypes import decode_text, spark_type
from rowtide.operators.encode import BAD_FLOAT, BINARY, NOT_SENT, choose_encoder, has_binary
from rowtide.operators.messages import publish_time
from rowtide.operators.relations import (
    History,
    described_versions,
    relation_asof,
    relation_versions,
)
from rowtide.schemas import (
    DELETE,
    DELETE_MSG,
    INSERT,
    INSERT_MSG,
    ROW_MSGS,
    TRUNCATE_MSG,
    UPDATE,
    UPDATE_MSG,
)


def with_positions(log: DataFrame) -> DataFrame:
    """Text positions to numbers: `commit_pos`, `wal_pos`, `end_pos`."""
    return log.select(
        "arrival",
        "kind",
        "xid",
        parse_lsn(F.col("commit_lsn")).alias("commit_pos"),
        "ord",
        parse_lsn(F.col("wal_start")).alias("wal_pos"),
        parse_lsn(F.col("wal_end")).alias("end_pos"),
        "relation_id",
        "relation_ids",
        "relation",
        "old_tuple",
        "new_tuple",
        "reply_requested",
    )


def decode_changes(
    log: DataFrame,
    versions: DataFrame | None = None,
    pk: DataFrame | None = None,
    roots: DataFrame | None = None,
    old_key_tombstones: bool = True,
    ts: Column | None = None,
    strict: bool = False,
    known: History | None = None,
) -> DataFrame:
    """Row changes of a positioned log as messages, `error` set for bad ones.

    One pass over the log serves every relation and every version of it, with
    names and types taken from the relation messages, so no schema is declared.
    `versions` is the relation history when it reaches back before this log, `known`
    the same when it has been prepared.
    `strict` fails the job on a change of an unknown relation. An update that
    moves a row to another key also ends the old key; without
    `old_key_tombstones` the row stays under both.
    """
    if known is None:
        history = relation_versions(log) if versions is None else versions
        known = History(described_versions(history, pk, roots))
    encoder = choose_encoder(known)
    changes = log.filter(F.col("kind").isin(*ROW_MSGS)).select(
        "kind", "relation_id", "commit_pos", "ord", "old_tuple", "new_tuple"
    )
    joined = encoder.prepare(known.attach(changes))
    is_delete = F.col("kind") == DELETE_MSG
    sent = F.when(is_delete, F.col("old_tuple")).otherwise(F.col("new_tuple"))
    op = F.when(is_delete, DELETE).when(F.col("kind") == UPDATE_MSG, UPDATE).otherwise(INSERT)
    encoded = encoder.encode(
        joined.select("*", op.alias("op"), sent.alias("_sent")), old_key_tombstones
    )
    messages = _with_old_keys(encoded) if old_key_tombstones else encoded
    return messages.select(
        "table",
        "op",
        "key",
        "value",
        "commit_pos",
        "ord",
        (publish_time() if ts is None else ts).alias("ts"),
        format_lsn(F.col("commit_pos")).alias("lsn"),
        _change_error(strict).alias("error"),
        "relation_id",
    )


def _change_error(strict: bool) -> Column:
    unknown: Column = F.lit("unknown_relation")
    if strict:
        unknown = F.raise_error(
            F.concat(F.lit("change of unknown relation "), F.col("relation_id").cast("string"))
        ).cast("string")
    # A tombstone needs its key alone.
    has_value = F.col("op") != DELETE
    return (
        F.when(F.col("table").isNull(), unknown)
        .when(F.col("_sent").isNull() & (F.col("op") == DELETE), "delete_without_old_tuple")
        .when(has_value & has_binary("_sent"), "binary_tuple")
        .when(F.col("_key_state") == BINARY, "binary_tuple")
        .when(has_value & F.col("_bad_float"), "unencodable_float")
        .when(F.col("_key_state") == BAD_FLOAT, "unencodable_float")
        .when(F.col("_key_state") == NOT_SENT, "key_not_sent")
    )


def _with_old_keys(encoded: DataFrame) -> DataFrame:
    """Add a tombstone for the key an update moved away from.

    An update in error ends nothing: the row lives on as it was.
    """
    message = F.struct("op", "key", "value")
    tombstone = F.struct(
        F.lit(DELETE).alias("op"),
        F.col("_old_key").alias("key"),
        F.lit(None).cast("string").alias("value"),
    )
    moved = (F.col("_old_key") != F.col("key")) & _change_error(False).isNull()
    both = F.when(moved, F.array(message, tombstone)).otherwise(F.array(message))
    rest = [c for c in encoded.columns if c not in ("op", "key", "value")]
    return encoded.withColumn("_message", F.explode(both)).select(*rest, "_message.*")


def typed_rows(
    log: DataFrame,
    columns: Sequence[tuple[str, int]],
    relation_id: int | None = None,
    old: Sequence[str] = (),
) -> DataFrame:
    """Row changes of one known relation with typed columns.

    Beside each column `c` stands `c__sent`: false when the log omitted the
    value because it did not change. Text that does not parse is NULL here.
    Columns named in `old` also give `c__old`, from the old tuple, if it has them.
    """
    changes = log.filter(F.col("kind").isin(*ROW_MSGS))
    if relation_id is not None:
        changes = changes.filter(F.col("relation_id") == relation_id)
    is_delete = F.col("kind") == DELETE_MSG
    sent = F.when(is_delete, F.col("old_tuple")).otherwise(F.col("new_tuple"))
    projected: list[Column] = []
    for i, (name, oid) in enumerate(columns):
        field = F.get("_sent", F.lit(i))
        dtype: T.DataType = spark_type(oid)
        value = F.when(field["status"] == "t", decode_text(field["data"], dtype))
        projected += [
            value.alias(name),
            F.coalesce(field["status"] != "u", F.lit(False)).alias(f"{name}__sent"),
        ]
        if name in old:
            before = F.get("old_tuple", F.lit(i))
            known = F.when(before["status"] == "t", decode_text(before["data"], dtype))
            projected.append(known.alias(f"{name}__old"))
    op = F.when(is_delete, DELETE).when(F.col("kind") == INSERT_MSG, INSERT).otherwise(UPDATE)
    return changes.withColumn("_sent", sent).select(
        op.alias("op"), "commit_pos", "ord", *projected
    )


def truncate_audit(log: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """One row per truncated table; unknown relations are skipped.

    A truncate is reported, not turned into deletes.
    """
    history = relation_versions(log) if versions is None else versions
    truncated = log.filter(F.col("kind") == TRUNCATE_MSG).select(
        F.explode("relation_ids").alias("relation_id"), "commit_pos", "ord"
    )
    return (
        relation_asof(truncated, described_versions(history).drop("shape"))
        .filter("table IS NOT NULL")
        .select("table", "commit_pos", "ord")
    )


def commit_positions(log: DataFrame) -> DataFrame:
    """Commit position of every transaction: `xid, commit_pos`."""
    return (
        log.filter("kind = 'C'").groupBy("xid").agg(F.max("commit_pos").alias("commit_pos"))
    )


def distinct_changes(log: DataFrame) -> DataFrame:
    """Drop resent copies of row changes and truncates.

    The order key names a change exactly, whichever session delivered it.
    """
    return log.filter(F.col("kind").isin(*ROW_MSGS, TRUNCATE_MSG)).dropDuplicates(
        ["commit_pos", "ord"]
    )
