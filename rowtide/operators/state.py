"""What a consumer rebuilds from the messages: current and past tables.

Every operator is one grouped aggregate over `(commit_pos, ord)`. It needs no
sorted input and combines on the map side, so a key with a third of all rows
leaves each input partition as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowtide.operators.sizes import broadcast_if_small
from rowtide.schemas import DELETE

KEY = ("table", "key")


def newest_per_key(messages: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Newest message of each key, tombstones included."""
    rest = [c for c in messages.columns if c not in key]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct("commit_pos", "ord"))
    return messages.groupBy(*key).agg(newest.alias("_m")).select(*key, "_m.*")


def current_table(
    messages: DataFrame, key: Sequence[str] = KEY, truncates: DataFrame | None = None
) -> DataFrame:
    """Live rows: the newest message per key unless it is a tombstone.

    `truncates(table, commit_pos, ord)` also removes what came before a
    truncate of the table; by default truncates are not applied. Messages in
    error have no place in a table.
    """
    if "error" in messages.columns:
        messages = messages.filter("error IS NULL").drop("error")
    if truncates is not None:
        messages = after_truncates(messages, truncates)
    return newest_per_key(messages, key).filter(F.col("op") != DELETE)


def table_as_of(messages: DataFrame, position: int, key: Sequence[str] = KEY) -> DataFrame:
    """Live rows once every transaction up to `position` was applied.

    Rows of an unpinned snapshot have no position; they come before every change.
    """
    pos = F.col("commit_pos")
    return current_table(messages.filter(pos.isNull() | (pos <= position)), key)


def after_truncates(messages: DataFrame, truncates: DataFrame) -> DataFrame:
    """Messages not wiped by a later truncate of their table."""
    last = truncates.groupBy("table").agg(F.max(F.struct("commit_pos", "ord")).alias("_cut"))
    return (
        messages.join(broadcast_if_small(last), "table", "left")
        .filter(F.col("_cut").isNull() | (F.struct("commit_pos", "ord") > F.col("_cut")))
        .drop("_cut")
    )


def fill_omitted(
    changes: DataFrame, key: Sequence[str], columns: Sequence[str], keep_deleted: bool = False
) -> DataFrame:
    """Live rows with omitted values taken from the last change that sent them.

    `changes` is the output of `typed_rows`. A delete ends a row's life, and a
    later row of the same key starts without the earlier values: a value
    counts only when it was sent after the key's last delete. Since the newest
    sent value is the only candidate, no second pass over the log is needed.
    """
    at = F.struct("commit_pos", "ord")
    is_delete = F.col("op") == DELETE
    sent = [
        F.max(
            F.when(
                ~is_delete & F.col(f"{c}__sent"),
                F.struct(at.alias("at"), F.col(c).alias("value")),
            )
        ).alias(f"_{c}")
        if orderable(changes, c)
        else F.max_by(
            F.struct(at.alias("at"), F.col(c).alias("value")),
            F.when(~is_delete & F.col(f"{c}__sent"), at),
        ).alias(f"_{c}")
        for c in columns
    ]
    collected = changes.groupBy(*key).agg(
        F.max(F.struct(at.alias("at"), "op")).alias("_last"),
        F.max(F.when(is_delete, at)).alias("_died"),
        *sent,
    )
    if not keep_deleted:
        collected = collected.filter(F.col("_last.op") != DELETE)

    def filled(c: str):
        alive = F.col("_died").isNull() | (F.col(f"_{c}.at") > F.col("_died"))
        return F.when(alive, F.col(f"_{c}.value")).alias(c)

    return collected.select(
        *key,
        F.col("_last.op").alias("op"),
        F.col("_last.at.commit_pos").alias("commit_pos"),
        F.col("_last.at.ord").alias("ord"),
        *[filled(c) for c in columns],
    )


def orderable(df: DataFrame, column: str) -> bool:
    """Whether `max` accepts the column; variants and maps cannot be compared."""
    return df.schema[column].dataType.typeName() not in ("variant", "map")
