"""Message form: headers, compaction, order, capability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.lsn import (
    format_lsn,
    format_lsn_exact,
    parse_lsn,
    parse_lsn_exact,
)
from rowtide.operators.decode import decode_changes
from rowtide.operators.messages import compact, kafka_layout, ordered_by_key
from rowtide.operators.snapshot import snapshot_table
from rowtide.queries.feed import FEED_SQL, change_log
from rowtide.queries.registry import query, table


@query("""
    SELECT event_id, printf('%X/%X', lsn >> 32, lsn & 4294967295) AS lsn_text, lsn AS lsn_number,
      printf('%X/%X', 4026531840 + lsn % 65536, lsn & 4294967295) AS high_text,
      CAST((4026531840 + lsn % 65536)::HUGEINT * 4294967296 + (lsn & 4294967295) AS VARCHAR) AS high_number
    FROM (SELECT event_id, event_id * 1000003 + 4294967296 AS lsn FROM events)""")
def lsn_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions to text and back, below and above 2^63."""
    events = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") * 1000003 + 2**32).alias("lsn")
    )
    low = F.col("lsn").bitwiseAND(F.lit(2**32 - 1))
    high = F.concat(F.hex(F.col("lsn") % 65536 + 4026531840), F.lit("/"), F.hex(low))
    exact = parse_lsn_exact(F.col("high_text"))
    return (
        events.withColumn("lsn_text", format_lsn(F.col("lsn")))
        .withColumn("high_text", high)
        .select(
            "event_id",
            "lsn_text",
            parse_lsn(F.col("lsn_text")).alias("lsn_number"),
            format_lsn_exact(exact).alias("high_text"),
            exact.cast("string").alias("high_number"),
        )
    )


@query(f"""
    WITH {FEED_SQL}
    SELECT key, h_table, h_op, h_lsn, headers FROM (
      SELECT '{{"user_id":' || user_id || '}}' AS key, 'public.users' AS h_table, op AS h_op,
        printf('%X/%X', commit_pos >> 32, commit_pos & 4294967295) AS h_lsn, 4 AS headers FROM feed
      UNION ALL
      SELECT '{{"c_custkey":' || c_custkey || '}}', 'public.customer', 'r', NULL, 3 FROM customer)""")
def message_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of changes and of snapshot rows; only changes carry `lsn`."""
    changes = decode_changes(change_log(spark, sf_dir))
    rows = snapshot_table(table(spark, sf_dir, "customer"), "public.customer", ["c_custkey"], 2**32)
    messages = kafka_layout(changes.unionByName(rows, allowMissingColumns=True))

    def header(i: int):
        return F.get("headers", F.lit(i))["value"].cast("string")

    return messages.select(
        "key",
        header(0).alias("h_table"),
        header(1).alias("h_op"),
        header(3).alias("h_lsn"),
        F.size("headers").alias("headers"),
    )


@query(f"""
    WITH {FEED_SQL}
    SELECT '{{"user_id":' || user_id || '}}' AS key, max(commit_pos * 8 + ord) AS log_offset,
      arg_max(op, commit_pos * 8 + ord) AS op FROM feed GROUP BY user_id""")
def log_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest record of each key survives, tombstones included."""
    topic = decode_changes(change_log(spark, sf_dir)).select(
        "key", "op", (F.col("commit_pos") * 8 + F.col("ord")).alias("log_offset")
    )
    return compact(topic, order="log_offset").select("key", "log_offset", "op")


@query(f"""
    WITH {FEED_SQL}
    SELECT '{{"user_id":' || user_id || '}}' AS key, count(*) AS messages, 0 AS out_of_order
    FROM feed GROUP BY user_id""")
def publish_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a key lie in one partition, in log order."""
    messages = decode_changes(change_log(spark, sf_dir)).select(
        "table", "key", "value", "commit_pos", "ord"
    )
    placed = ordered_by_key(messages, 8).select(
        "key",
        F.monotonically_increasing_id().alias("place"),
        F.spark_partition_id().alias("part"),
        "commit_pos",
        "ord",
    )
    # In order when the newest message, the last place and the number of
    # partitions agree for every key.
    position = F.struct("commit_pos", "ord")
    per_key = placed.groupBy("key").agg(
        F.count("*").alias("messages"),
        F.countDistinct("part").alias("parts"),
        F.max("place").alias("last"),
        F.min("place").alias("first"),
        F.max_by("place", position).alias("newest"),
        F.min_by("place", position).alias("oldest"),
    )
    wrong = (F.col("parts") != 1) | (F.col("last") != F.col("newest")) | (F.col("first") != F.col("oldest"))
    return per_key.select("key", "messages", wrong.cast("int").alias("out_of_order"))
