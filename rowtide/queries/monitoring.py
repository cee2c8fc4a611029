"""Counters, gauges and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.lsn import format_lsn
from rowtide.operators.decode import decode_changes
from rowtide.operators.messages import split_quarantine
from rowtide.operators.monitor import (
    differing_keys,
    errors_by_stage,
    events_by_table_op,
    range_bits,
    retention_alerts,
    rows_by_table,
    slot_health,
    snapshot_in_progress,
    snapshot_run_in_progress,
    table_topic_parity,
)
from rowtide.operators.progress import latest_units
from rowtide.operators.snapshot import snapshot_partitioned, snapshot_table
from rowtide.operators.state import current_table
from rowtide.queries.changes import VERSION_CTE, versioned_log
from rowtide.queries.feed import FEED_SQL, change_log, feed
from rowtide.queries.progress import UNIT_STATE_SQL, month_units
from rowtide.queries.registry import query, table
from rowtide.queries.snapshots import order_children
from rowtide.sources.change_log import keepalives


@query("""
    SELECT 'public.customer' AS "table", count(*) AS snapshot_rows FROM customer
    UNION ALL SELECT 'public.orders', count(*) FROM orders""")
def snapshot_rows_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows by published name, children under their root."""
    customers = snapshot_table(table(spark, sf_dir, "customer"), "public.customer", ["c_custkey"])
    children = order_children(spark, sf_dir)
    orders = snapshot_partitioned(spark, children, "public.orders", ["o_orderkey"])
    return rows_by_table(customers.select("table", "op").unionByName(orders.select("table", "op")))


@query(f"""
    WITH {FEED_SQL}, {VERSION_CTE}
    SELECT 'public.' || f.event_type AS "table", f.op, count(*) AS events
    FROM (SELECT *, commit_pos * 8 + ord AS at FROM feed) f
    ASOF JOIN versions v ON f.event_type = v.event_type AND f.at >= v.at GROUP BY ALL""")
def change_events_by_table_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published change events by table and operation."""
    good, _ = split_quarantine(decode_changes(versioned_log(feed(spark, sf_dir))))
    return events_by_table_op(good)


@query(f"""
    WITH {FEED_SQL}, {VERSION_CTE}
    SELECT CASE f.op WHEN 'c' THEN 'insert' WHEN 'u' THEN 'update' ELSE 'delete' END AS stage,
      count(*) AS errors
    FROM (SELECT *, commit_pos * 8 + ord AS at FROM feed) f
    WHERE NOT EXISTS (SELECT 1 FROM versions v WHERE v.event_type = f.event_type AND v.at <= f.at)
    GROUP BY 1""")
def publish_errors_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that could not be published, by stage."""
    _, bad = split_quarantine(decode_changes(versioned_log(feed(spark, sf_dir))))
    return errors_by_stage(bad)


SAMPLES_SQL = f"""{FEED_SQL}, newest AS (
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id,
      arg_max(value, event_id) AS value FROM feed GROUP BY user_id),
  health AS (
    SELECT 'slot_' || c_custkey AS slot_name,
      CASE WHEN user_id IS NULL OR event_type = 'error' THEN 0.0 ELSE 1.0 END AS slot_active,
      CASE WHEN user_id IS NULL THEN NULL WHEN event_type = 'view' THEN 0
        ELSE CAST(floor(value) AS BIGINT) * 20000000 END AS retained_bytes,
      CASE WHEN user_id IS NULL THEN 'slot_missing' END AS error
    FROM customer LEFT JOIN newest ON user_id = c_custkey)"""


def slot_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    wanted = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("slot_"), "c_custkey").alias("slot_name")
    )
    kept = F.floor("value").cast("bigint") * 20_000_000
    samples = feed(spark, sf_dir).select(
        F.timestamp_seconds("event_id").alias("sampled_at"),
        F.concat(F.lit("slot_"), "user_id").alias("slot_name"),
        (F.col("event_type") != "error").alias("active"),
        F.when(F.col("event_type") != "view", format_lsn(F.col("lsn"))).alias("restart_lsn"),
        format_lsn(F.col("lsn")).alias("confirmed_flush_lsn"),
        format_lsn(F.col("lsn") + kept).alias("current_wal_lsn"),
    )
    return wanted, samples


@query(f"""
    WITH {SAMPLES_SQL}
    SELECT slot_name, CAST(slot_active AS DOUBLE) AS slot_active, retained_bytes, error,
      coalesce(retained_bytes > 536870912, FALSE) AS alert FROM health""")
def slot_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauges of every wanted slot, missing ones included."""
    health = slot_health(*slot_samples(spark, sf_dir))
    return health.select("slot_name", "slot_active", "retained_bytes", "error", "alert")


@query(f"""
    WITH {SAMPLES_SQL}
    SELECT slot_name, retained_bytes FROM health WHERE retained_bytes > 1000000000""")
def slot_lag_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that keep strictly more log than the threshold."""
    health = slot_health(*slot_samples(spark, sf_dir), warn_bytes=1_000_000_000)
    return retention_alerts(health).select("slot_name", "retained_bytes")


@query(f"""
    WITH {UNIT_STATE_SQL}
    SELECT substr(unit, 8, 4) AS pipeline,
      CAST(max(CASE WHEN done = FALSE THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS snapshot_in_progress
    FROM units LEFT JOIN state USING (unit) GROUP BY 1""")
def snapshots_in_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines with a unit that was begun and not finished."""
    units, log = month_units(spark, sf_dir)
    named = units.withColumn("pipeline", F.substring("unit", 8, 4))
    return snapshot_in_progress(named, latest_units(log))


@query(f"""
    WITH {UNIT_STATE_SQL}
    SELECT substr(unit, 8, 4) AS pipeline,
      CAST(CASE WHEN count(done) > 0 AND count(*) FILTER (done) < count(*) THEN 1 ELSE 0 END AS DOUBLE)
        AS snapshot_in_progress
    FROM units LEFT JOIN state USING (unit) GROUP BY 1""")
def snapshot_runs_in_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines whose snapshot has begun and is not finished, between units too."""
    units, log = month_units(spark, sf_dir)
    named = units.withColumn("pipeline", F.substring("unit", 8, 4))
    return snapshot_run_in_progress(named, latest_units(log))


@query("""
    SELECT 'public.orders' AS "table", count(*) AS table_rows,
      count(*) FILTER (o_orderstatus <> 'F') AS topic_rows,
      count(*) FILTER (o_orderstatus = 'F') AS missing_keys, CAST(0 AS BIGINT) AS extra_keys,
      count(*) FILTER (o_orderstatus = 'F') = 0 AS in_parity FROM orders
    UNION ALL
    SELECT 'public.customer', count(*), count(*), 0, 0, TRUE FROM customer""")
def table_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables against their topic: one complete, one with rows missing."""
    orders = table(spark, sf_dir, "orders")
    customers = snapshot_table(table(spark, sf_dir, "customer"), "public.customer", ["c_custkey"])
    all_orders = snapshot_table(orders, "public.orders", ["o_orderkey"])
    some = snapshot_table(orders.filter("o_orderstatus <> 'F'"), "public.orders", ["o_orderkey"])
    keys = customers.select("table", "key").unionByName(all_orders.select("table", "key"))
    published = customers.unionByName(some).select("table", "key", "op", "commit_pos", "ord")
    return table_topic_parity(keys, current_table(published))


@query("""
    SELECT 'public.orders' AS "table", '{"o_orderkey":' || o_orderkey || '}' AS key,
      CASE WHEN o_orderkey % 1009 = 0 THEN 'missing' ELSE 'changed' END AS fault
    FROM orders WHERE o_orderkey % 1009 = 0 OR o_orderkey % 2003 = 5
    UNION ALL
    SELECT 'public.orders', '{"o_orderkey":' || -o_orderkey || '}', 'extra' FROM orders WHERE o_orderkey % 1511 = 7""")
def parity_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against its topic by digests of key ranges: rows missing, changed and too many."""
    orders = table(spark, sf_dir, "orders")
    customers = snapshot_table(table(spark, sf_dir, "customer"), "public.customer", ["c_custkey"])
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    changed = orders.filter(key % 1009 != 0).withColumn(
        "o_totalprice", F.when(key % 2003 == 5, price + 1).otherwise(price)
    )
    extra = orders.filter(key % 1511 == 7).withColumn("o_orderkey", -key)
    source = snapshot_table(orders, "public.orders", ["o_orderkey"]).unionByName(customers)
    topic = snapshot_table(changed.unionByName(extra), "public.orders", ["o_orderkey"]).unionByName(customers)
    return differing_keys(source, topic, range_bits(orders.count(), 100))


@query(f"""
    WITH {FEED_SQL}
    SELECT count(*) AS keepalives, count(*) FILTER (event_type = 'error') AS replies,
      max(commit_pos) + 400 AS server_pos FROM feed WHERE ord = 0""")
def keepalive_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position-only messages and the replies they ask for."""
    return keepalives(change_log(spark, sf_dir)).agg(
        F.count("*").alias("keepalives"),
        F.count_if("reply_requested").alias("replies"),
        F.max("end_pos").alias("server_pos"),
    )
