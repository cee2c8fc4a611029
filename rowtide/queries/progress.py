"""Checkpoints, start and safe positions, pending work, the boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.lsn import format_lsn
from rowtide.operators.decode import decode_changes
from rowtide.operators.progress import (
    bootstrap_decision,
    checkpoint_units,
    latest_units,
    load_checkpoint,
    pending_units,
    safe_position,
    skip_finished,
    start_positions,
    with_boundary,
)
from rowtide.operators.snapshot import snapshot_table
from rowtide.operators.state import current_table
from rowtide.queries.feed import FEED_SQL, change_log, feed
from rowtide.queries.registry import query, table

LSN_SQL = "printf('%X/%X', lsn >> 32, lsn & 4294967295)"

# One state topic per user. Signups write nothing, errors broken JSON, clicks
# under another key, views a value of the wrong type.
STATE_TOPIC_SQL = f"""{FEED_SQL}, good AS (
    SELECT user_id, event_id, {LSN_SQL} AS confirmed_lsn FROM feed WHERE event_type = 'purchase')"""


def state_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    lsn = format_lsn(F.col("lsn"))
    good = F.concat(
        F.lit('{"confirmed_lsn":"'),
        lsn,
        F.lit('","snapshots":{"public.a":{"done":true},"public.b":{"done":false,"last_pk":['),
        F.col("event_id").cast("string"),
        F.lit(',"x"]}},"updated_at":"2026-01-15T10:00:00Z"}'),
    )
    value = (
        F.when(F.col("event_type") == "signup", "")
        .when(F.col("event_type") == "error", F.concat(F.lit('{"confirmed_lsn":"'), lsn))
        .when(F.col("event_type") == "view", '{"confirmed_lsn":5,"snapshots":{}}')
        .otherwise(good)
    )
    return feed(spark, sf_dir).select(
        "user_id",
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "click", "other").otherwise("checkpoint").alias("key"),
        value.alias("value"),
    )


@query(f"""
    WITH {STATE_TOPIC_SQL}
    SELECT user_id, arg_max(confirmed_lsn, event_id) AS confirmed_lsn, 2 AS units
    FROM good GROUP BY user_id""")
def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last valid checkpoint of every state topic."""
    found = load_checkpoint(state_topic(spark, sf_dir), by=["user_id"])
    return found.select("user_id", "confirmed_lsn", F.size("snapshots").alias("units"))


@query(f"""
    WITH {STATE_TOPIC_SQL}
    SELECT user_id, u.unit, u.unit = 'public.a' AS done,
      CASE WHEN u.unit = 'public.b' THEN '[' || max(event_id) || ',"x"]' END AS last_pk
    FROM good, (VALUES ('public.a'), ('public.b')) AS u(unit) GROUP BY user_id, u.unit""")
def checkpoint_unit_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit states inside the checkpoints, cursors kept as JSON text."""
    found = load_checkpoint(state_topic(spark, sf_dir), by=["user_id"])
    return checkpoint_units(found, by=["user_id"])


SLOTS_SQL = f"""{FEED_SQL},
  slots AS (SELECT user_id, max(lsn) AS at FROM feed GROUP BY user_id),
  saved AS (SELECT user_id, max(lsn) AS at FROM feed WHERE event_type = 'purchase' AND value > 60 GROUP BY 1),
  created AS (SELECT user_id, min(lsn) AS at FROM feed WHERE event_type = 'error' AND value > 60 GROUP BY 1)"""


def slot_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = feed(spark, sf_dir).withColumn("slot_name", F.concat(F.lit("slot_"), "user_id"))
    slots = events.groupBy("slot_name").agg(
        format_lsn(F.max("lsn")).alias("confirmed_flush_lsn")
    )
    saved = (
        events.filter("event_type = 'purchase' AND value > 60")
        .groupBy("slot_name")
        .agg(format_lsn(F.max("lsn")).alias("confirmed_lsn"))
    )
    created = (
        events.filter("event_type = 'error' AND value > 60")
        .groupBy("slot_name")
        .agg(format_lsn(F.min("lsn")).alias("consistent_point"))
    )
    return slots, saved, created


@query(f"""
    WITH {SLOTS_SQL}
    SELECT 'slot_' || user_id AS slot_name, coalesce(saved.at, created.at, slots.at) AS start_pos,
      printf('%X/%X', coalesce(saved.at, created.at, slots.at) >> 32,
        coalesce(saved.at, created.at, slots.at) & 4294967295) AS start_lsn
    FROM slots LEFT JOIN saved USING (user_id) LEFT JOIN created USING (user_id)""")
def start_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint, else consistent point, else the slot's own position."""
    return start_positions(*slot_frames(spark, sf_dir)).select("slot_name", "start_pos", "start_lsn")


@query(f"""
    WITH {FEED_SQL},
    log AS (
      SELECT 'slot_' || (event_id // 15) % 7 AS slot_name, xid * 8 + 1 + ord AS arrival,
        lsn AS seen, NULL AS commit_pos FROM feed
      UNION ALL
      SELECT 'slot_' || (event_id // 15) % 7, xid * 8 + 6, commit_pos + 2, commit_pos
      FROM feed WHERE ord = 0
      UNION ALL
      SELECT 'slot_' || (event_id // 15) % 7, xid * 8 + 7, commit_pos + 400, NULL
      FROM feed WHERE ord = 0),
    run AS (
      SELECT *, coalesce(max(commit_pos) OVER (PARTITION BY slot_name ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4294967300) AS last_commit FROM log),
    reset AS (
      SELECT slot_name, max(arrival) AS at, arg_max(commit_pos, arrival) AS commit_pos
      FROM run WHERE commit_pos > greatest(last_commit, 4294967300) GROUP BY slot_name)
    SELECT log.slot_name, greatest(reset.commit_pos,
      coalesce(max(seen) FILTER (log.arrival > reset.at), 0)) AS safe_pos
    FROM log JOIN reset ON log.slot_name = reset.slot_name GROUP BY log.slot_name, reset.commit_pos""")
def safe_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position each slot may confirm after its whole log."""
    # Arrival tells the transaction, three of which make a block.
    block = F.expr("arrival div 24")
    log = change_log(spark, sf_dir).filter("kind <> 'R'").withColumn(
        "slot_name", F.concat(F.lit("slot_"), block % 7)
    )
    slot = F.concat(F.lit("slot_"), F.expr("(event_id div 15) % 7"))
    starts = (
        table(spark, sf_dir, "events")
        .select(slot.alias("slot_name"))
        .distinct()
        .withColumn("start_pos", F.lit(2**32 + 4))
    )
    return safe_position(log, starts).select("slot_name", "safe_pos")


def month_units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Units are months of orders by customer group, ten a month.

    Most orders save their unit's state; status F finishes it, and a later
    order may begin it again.
    """
    month = F.date_format("o_orderdate", "'orders_'yyyy_MM")
    orders = table(spark, sf_dir, "orders").withColumn(
        "unit", F.concat_ws("_", month, F.col("o_custkey") % 10)
    )
    log = orders.filter("o_orderpriority <> '5-LOW'").select(
        "unit",
        (F.col("o_orderstatus") == "F").alias("done"),
        F.concat(F.lit("["), "o_orderkey", F.lit("]")).alias("last_pk"),
        F.timestamp_seconds("o_orderkey").alias("saved_at"),
    )
    return orders.select("unit").distinct(), log


UNIT_STATE_SQL = """units AS (
    SELECT DISTINCT strftime(o_orderdate, 'orders_%Y_%m_') || o_custkey % 10 AS unit FROM orders),
  state AS (
    SELECT strftime(o_orderdate, 'orders_%Y_%m_') || o_custkey % 10 AS unit,
      arg_max(o_orderstatus = 'F', o_orderkey) AS done, '[' || max(o_orderkey) || ']' AS last_pk
    FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"""


@query(f"""
    WITH {UNIT_STATE_SQL}
    SELECT unit, last_pk FROM units LEFT JOIN state USING (unit) WHERE done IS NOT TRUE""")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units still to read and where to continue."""
    units, log = month_units(spark, sf_dir)
    return pending_units(units, latest_units(log))


@query(f"""
    WITH {UNIT_STATE_SQL}
    SELECT unit FROM units WHERE unit NOT IN (SELECT unit FROM state WHERE done)""")
def unfinished_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that are not finished."""
    units, log = month_units(spark, sf_dir)
    return skip_finished(units, latest_units(log))


@query(f"""
    WITH {FEED_SQL},
    objects AS (SELECT DISTINCT user_id, event_type FROM feed),
    done AS (SELECT DISTINCT user_id, event_type FROM feed WHERE value > 30),
    created AS (SELECT DISTINCT user_id FROM feed WHERE value > 95)
    SELECT 'slot_' || o.user_id AS slot_name,
      CASE WHEN bool_or(c.user_id IS NOT NULL) THEN 'pinned_snapshot'
        WHEN count(*) FILTER (d.user_id IS NULL) > 0 THEN 'recovery_snapshot' ELSE 'stream' END AS action
    FROM objects o LEFT JOIN done d USING (user_id, event_type) LEFT JOIN created c USING (user_id)
    GROUP BY o.user_id""")
def bootstrap_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each slot does first."""
    events = feed(spark, sf_dir).select(
        F.concat(F.lit("slot_"), "user_id").alias("slot_name"),
        F.col("event_type").alias("unit"),
        "value",
    )
    objects = events.select("slot_name", "unit").distinct()
    state = events.filter("value > 30").select("slot_name", "unit").distinct().withColumn("done", F.lit(True))
    created = events.filter("value > 95").select("slot_name").distinct()
    return bootstrap_decision(objects, state, created).select("slot_name", "action")


@query(f"""
    WITH {FEED_SQL},
    point AS (SELECT (min(commit_pos) + max(commit_pos)) // 2 AS p FROM feed),
    merged AS (
      SELECT '{{"user_id":' || c_custkey || '}}' AS key, 'r' AS op, p AS commit_pos, -1 AS ord
      FROM customer, point
      UNION ALL
      SELECT '{{"user_id":' || user_id || '}}', op, commit_pos, ord FROM feed, point WHERE commit_pos >= p)
    SELECT key, op, commit_pos, ord FROM merged
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY commit_pos DESC, ord DESC) = 1 AND op <> 'd'""")
def hybrid_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows and later changes meet at one commit position."""
    point = (
        feed(spark, sf_dir)
        .agg(F.expr("(min(commit_pos) + max(commit_pos)) div 2").alias("p"))
        .first()["p"]
    )
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    rows = snapshot_table(users, "public.users", ["user_id"], position=point)
    both = with_boundary(rows, decode_changes(change_log(spark, sf_dir)), point)
    return current_table(both.select("table", "key", "op", "commit_pos", "ord")).drop("table")
