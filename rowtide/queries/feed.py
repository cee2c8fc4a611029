"""A change log derived from the `events` table.

Fifteen consecutive events form three interleaved transactions, so the order
of row positions and the order of commits differ. The event type decides the
operation; `view` events do not send `props`, as for an unchanged large value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.queries.registry import table
from rowtide.schemas import POSITIONED_FIELDS, TUPLE

BASE = 2**32
USERS = 16384
SESSION_EVENTS = 1500

# The same feed in SQL, as a CTE.
FEED_SQL = """feed AS (
  SELECT event_id, user_id, event_type, value, props,
    event_id * 16 + 4294967296 AS lsn,
    (event_id // 15) * 3 + event_id % 3 AS xid,
    (event_id // 3) % 5 AS ord,
    ((event_id // 15) * 15 + 14) * 16 + 4294967296 + 4 + 4 * (event_id % 3) AS commit_pos,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events)"""

USER_COLUMNS = (("user_id", 20), ("value", 701), ("props", 25))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their place in the log."""
    e = F.col("event_id")
    block = F.expr("event_id div 15")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        (e * 16 + BASE).alias("lsn"),
        (block * 3 + e % 3).alias("xid"),
        F.expr("(event_id div 3) % 5").alias("ord"),
        ((block * 15 + 14) * 16 + BASE + 4 + (e % 3) * 4).alias("commit_pos"),
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
        .alias("op"),
    )


def text(value: Column) -> Column:
    """A tuple column in text form; NULL data has status `n`."""
    return F.struct(
        F.when(value.isNull(), "n").otherwise("t").alias("status"),
        value.cast("string").alias("data"),
    )


def marked(status: str) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(None).cast("string").alias("data"))


def relation(namespace: str, name: str, columns: list[tuple[str, int, int]]) -> Column:
    """A relation message's payload from `(name, type oid, flags)`."""
    fields = [
        F.struct(
            F.lit(c).alias("name"),
            F.lit(oid).cast("bigint").alias("type_oid"),
            F.lit(flags).alias("flags"),
        )
        for c, oid, flags in columns
    ]
    return F.struct(
        F.lit(namespace).alias("namespace"),
        F.lit(name).alias("name"),
        F.array(*fields).alias("columns"),
    )


def log_rows(frame: DataFrame, kind: str | Column, **columns: Column) -> DataFrame:
    """Rows of the positioned log; columns not given are NULL."""
    given = {"kind": F.lit(kind) if isinstance(kind, str) else kind, **columns}
    for name in ("xid", "commit_pos", "ord"):
        if name in frame.columns:
            given.setdefault(name, F.col(name))
    return frame.select(
        *[given.get(c, F.lit(None)).cast(ddl).alias(c) for c, ddl in POSITIONED_FIELDS.items()]
    )


def kind_of(op: Column) -> Column:
    return F.when(op == "c", "I").when(op == "d", "D").otherwise("U")


def user_changes(events: DataFrame, relation_id: Column | None = None) -> DataFrame:
    """Row changes of the users relation, one per event."""
    sent_props = F.when(F.col("event_type") == "view", marked("u")).otherwise(text(F.col("props")))
    full = F.array(text(F.col("user_id")), text(F.col("value")), sent_props).cast(TUPLE)
    key_only = F.array(text(F.col("user_id")), marked("n"), marked("n")).cast(TUPLE)
    dead = F.col("op") == "d"
    return log_rows(
        events,
        kind_of(F.col("op")),
        arrival=F.col("xid") * 8 + 1 + F.col("ord"),
        wal_pos=F.col("lsn"),
        relation_id=F.lit(USERS) if relation_id is None else relation_id,
        old_tuple=F.when(dead, key_only),
        new_tuple=F.when(~dead, full),
    )


def first_change(events: DataFrame, *by: Column) -> DataFrame:
    """Position of the first change, of the whole feed or of each group."""
    first = F.min(F.struct("commit_pos", "ord")).alias("first")
    found = events.groupBy(*by).agg(F.min("xid").alias("xid"), first)
    return found.select("xid", "first.*")


def session_relations(events: DataFrame) -> DataFrame:
    """The users relation, announced again at the start of every session."""
    return log_rows(
        first_change(events, F.expr(f"event_id div {SESSION_EVENTS}")),
        "R",
        arrival=F.col("xid") * 8,
        relation_id=F.lit(USERS),
        relation=relation("public", "users", [(c, o, int(c == "user_id")) for c, o in USER_COLUMNS]),
    )


def commits(events: DataFrame) -> DataFrame:
    """One commit per transaction, found at its first change."""
    return log_rows(
        events.filter("ord = 0"),
        "C",
        arrival=F.col("xid") * 8 + 6,
        wal_pos=F.col("commit_pos") + 2,
        end_pos=F.col("commit_pos") + 2,
    )


def server_positions(events: DataFrame) -> DataFrame:
    """A keepalive after every transaction. Its position is ahead of the next
    commits, so that those move the safe position back."""
    return log_rows(
        events.filter("ord = 0"),
        "K",
        xid=F.lit(None),
        commit_pos=F.lit(None),
        ord=F.lit(None),
        arrival=F.col("xid") * 8 + 7,
        end_pos=F.col("commit_pos") + 400,
        reply_requested=F.col("event_type") == "error",
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log: relations, row changes, commits and keepalives.

    The kinds are separate branches of a union, so a reader of one kind scans
    the events for that branch only.
    """
    events = feed(spark, sf_dir)
    return (
        user_changes(events)
        .unionByName(session_relations(events))
        .unionByName(commits(events))
        .unionByName(server_positions(events))
    )
