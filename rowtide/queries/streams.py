"""Streams over the derived log, run to the end of what is there."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.lsn import format_lsn
from rowtide.operators.decode import with_positions
from rowtide.operators.progress import load_checkpoint
from rowtide.operators.state import current_table
from rowtide.plans.snapshot import SourceObject, run_snapshot
from rowtide.queries.feed import FEED_SQL, change_log, feed, user_changes
from rowtide.queries.progress import LSN_SQL
from rowtide.queries.registry import query, table
from rowtide.queries.snapshots import order_children
from rowtide.queries.state import NEWEST
from rowtide.schemas import MESSAGE
from rowtide.session import shared_dir
from rowtide.sources.change_log import (
    STORED_LOG,
    land_change_log,
    landed_relations,
    quarantined_rows,
    read_change_log,
    stream_change_log,
    write_landing,
)
from rowtide.streaming.capture import (
    captured_messages,
    checkpoint_topic,
    start_capture,
    stream_messages,
)
from rowtide.streaming.tables import read_table, start_table


# Batches that the files of a landing are split over, if there are as many.
PARTS = 4


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/rowtide-{uuid4().hex}"


def landed_files(spark: SparkSession, path: str) -> int:
    """Files of changes landed so far, those of lost attempts among them."""
    return len(spark.read.schema(STORED_LOG).parquet(f"{path}/changes").inputFiles())


def captured(spark: SparkSession, sf_dir: str) -> str:
    """Land the log in two stretches, capture after each, return the folder.

    The second capture starts from what the first one left.
    """
    folder = new_folder(spark)
    log = change_log(spark, sf_dir)
    bounds = feed(spark, sf_dir).agg(F.min("xid").alias("low"), F.max("xid").alias("high")).first()
    middle = (bounds.low + bounds.high) // 2 * 8
    for stretch in (F.col("arrival") < middle, F.col("arrival") >= middle):
        land_change_log(log.filter(stretch), f"{folder}/log")
        start_capture(
            stream_change_log(spark, f"{folder}/log", files_per_batch=1000),
            folder,
            "users",
            relations=lambda: landed_relations(spark, f"{folder}/log"),
            path=f"{folder}/log",
        ).awaitTermination()
    return folder


def captured_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """Land the log in four stretches, capture a quarter of a stretch's files at a time.

    A landing has as many files as the session has shuffle partitions, so a set number
    of files at a time would be more batches on a larger cluster, of less work each.
    """
    folder = new_folder(spark)
    log = change_log(spark, sf_dir)
    bounds = feed(spark, sf_dir).agg(F.min("xid").alias("low"), F.max("xid").alias("high")).first()
    step = (bounds.high - bounds.low) // 4 + 1
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        for i in range(4):
            xid = F.expr("arrival div 8") - bounds.low
            land_change_log(log.filter((xid >= i * step) & (xid < (i + 1) * step)), f"{folder}/log")
    finally:
        spark.conf.set(merge, before)
    files = max(1, landed_files(spark, f"{folder}/log") // (4 * PARTS))
    start_capture(
        stream_change_log(spark, f"{folder}/log", files_per_batch=files),
        folder,
        "users",
        relations=lambda: landed_relations(spark, f"{folder}/log"),
        path=f"{folder}/log",
    ).awaitTermination()
    return folder


def captured_after_loss(spark: SparkSession, sf_dir: str) -> str:
    """Capture a landing that ended before its summary, then the whole log landed in its place.

    The lost attempt held the first half of the log. Its files and those of the
    repeated one are captured a quarter at a time.
    """
    folder = new_folder(spark)
    log = change_log(spark, sf_dir)
    bounds = feed(spark, sf_dir).agg(F.min("xid").alias("low"), F.max("xid").alias("high")).first()
    path = f"{folder}/log"

    def capture(files: int) -> None:
        start_capture(
            stream_change_log(spark, path, files_per_batch=max(1, files // PARTS)),
            folder,
            "users",
            relations=lambda: landed_relations(spark, path),
            path=path,
        ).awaitTermination()

    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    write_landing(log.filter(F.col("arrival") < (bounds.low + bounds.high) // 2 * 8), path, 0)
    lost = landed_files(spark, path)
    capture(lost)
    spark.conf.set(merge, "false")
    try:
        land_change_log(log, path)
    finally:
        spark.conf.set(merge, before)
    capture(landed_files(spark, path) - lost)
    return folder


def confirmed_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """For each batch its confirmed position and the lowest commit not yet published.

    A commit counts as published with the last batch that holds a change of it.
    """
    progress = spark.read.parquet(f"{folder}/progress").select("batch", "safe_pos")
    changes = spark.read.parquet(f"{folder}/messages").groupBy("commit_pos").agg(F.max("batch").alias("last"))
    lowest = changes.groupBy("last").agg(F.min("commit_pos").alias("low"))
    open_ = progress.join(lowest, lowest["last"] > progress["batch"], "left")
    return open_.groupBy("batch", "safe_pos").agg(F.min("low").alias("unpublished"))


@query(f"""
    WITH {FEED_SQL}
    SELECT 'public.users' AS "table", op, '{{"user_id":' || user_id || '}}' AS key, commit_pos, ord,
      CASE WHEN op <> 'd' THEN value END AS value
    FROM feed""")
def streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages captured from a stream are those of the batch."""
    messages = captured_messages(spark, captured(spark, sf_dir))
    value = F.get_json_object("value", "$.value").cast("double")
    return messages.select("table", "op", "key", "commit_pos", "ord", value.alias("value"))


@query(f"""
    WITH {FEED_SQL}
    SELECT '{{"user_id":' || user_id || '}}' AS key, op, commit_pos, ord FROM feed
    QUALIFY {NEWEST} AND op <> 'd'""")
def streamed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table kept current from the captured message stream."""
    folder = captured(spark, sf_dir)
    stream = stream_messages(spark, folder, files_per_batch=4)
    start_table(stream, f"{folder}/table").awaitTermination()
    return read_table(spark, f"{folder}/table").select("key", "op", "commit_pos", "ord")


@query(f"""
    WITH {FEED_SQL}, log AS (
      SELECT xid * 8 + 1 + ord AS arrival, lsn AS seen, NULL AS commit_pos FROM feed
      UNION ALL SELECT xid * 8 + 6, commit_pos + 2, commit_pos FROM feed WHERE ord = 0
      UNION ALL SELECT xid * 8 + 7, commit_pos + 400, NULL FROM feed WHERE ord = 0),
    top AS (SELECT max(commit_pos) AS c, arg_max(arrival, commit_pos) AS a FROM log),
    safe AS (SELECT greatest(max(c), coalesce(max(seen) FILTER (arrival > a), 0)) AS lsn FROM log, top)
    SELECT 0::BIGINT AS ahead, (SELECT lsn FROM safe) AS confirmed""")
def streamed_checkpoint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing split over many batches: no batch confirms a commit still to come."""
    batches = confirmed_by_batch(spark, captured_in_parts(spark, sf_dir))
    return batches.agg(
        F.count_if(F.col("safe_pos") > F.col("unpublished")).alias("ahead"),
        F.max("safe_pos").alias("confirmed"),
    )


@query(f"""
    WITH {FEED_SQL}, log AS (
      SELECT xid * 8 + 1 + ord AS arrival, lsn AS seen, NULL AS commit_pos FROM feed
      UNION ALL SELECT xid * 8 + 6, commit_pos + 2, commit_pos FROM feed WHERE ord = 0
      UNION ALL SELECT xid * 8 + 7, commit_pos + 400, NULL FROM feed WHERE ord = 0),
    top AS (SELECT max(commit_pos) AS c, arg_max(arrival, commit_pos) AS a FROM log),
    safe AS (SELECT greatest(max(c), coalesce(max(seen) FILTER (arrival > a), 0)) AS lsn FROM log, top)
    SELECT 0::BIGINT AS ahead, (SELECT lsn FROM safe) AS confirmed, count(*) AS changes,
      (SELECT count(*) FROM feed) AS landed FROM feed""")
def streamed_checkpoint_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing that was lost and repeated: no batch confirms a commit still to come.

    What the lost attempt published comes again, and is read once from the log.
    """
    folder = captured_after_loss(spark, sf_dir)
    batches = confirmed_by_batch(spark, folder).agg(
        F.count_if(F.col("safe_pos") > F.col("unpublished")).alias("ahead"),
        F.max("safe_pos").alias("confirmed"),
    )
    messages = captured_messages(spark, folder).select("commit_pos", "ord").distinct()
    landed = _landed_rows(spark, f"{folder}/log")
    counts = messages.agg(F.count("*").alias("changes")), landed.agg(F.count("*").alias("landed"))
    # Three single rows, side by side.
    one = F.lit(1).alias("one")
    first, second, third = (df.select("*", one) for df in (batches, *counts))
    return first.join(second, "one").join(third, "one").drop("one")


@query(f"""
    WITH {FEED_SQL}, point AS (SELECT (min(commit_pos) + 99 * max(commit_pos)) // 100 AS p FROM feed)
    SELECT lsn, op FROM feed, point WHERE commit_pos >= p""")
def log_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of a landed log from a position on."""
    path = f"{new_folder(spark)}/log"
    land_change_log(change_log(spark, sf_dir), path)
    point = feed(spark, sf_dir).agg(F.expr("(min(commit_pos) + 99 * max(commit_pos)) div 100").alias("p"))
    log = read_change_log(spark, path, start=point.first()["p"])
    op = F.when(F.col("kind") == "I", "c").when(F.col("kind") == "D", "d").otherwise("u")
    return log.filter(F.col("kind").isin("I", "U", "D")).select(F.col("wal_pos").alias("lsn"), op.alias("op"))


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, CASE WHEN event_type = 'click' THEN 'quarantine' ELSE 'changes' END AS "where" FROM feed""")
def malformed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose position does not parse are set aside when a log is landed."""
    path = f"{new_folder(spark)}/log"
    events = feed(spark, sf_dir)
    good = user_changes(events).drop("commit_pos", "wal_pos", "end_pos")
    position = F.when(F.col("event_type") == "click", "1/XYZ").otherwise(format_lsn(F.col("commit_pos")))
    texts = events.select(
        (F.col("xid") * 8 + 1 + F.col("ord")).alias("arrival"),
        position.alias("commit_lsn"),
        format_lsn(F.col("lsn")).alias("wal_start"),
        F.lit(None).cast("string").alias("wal_end"),
    )
    land_change_log(with_positions(good.join(texts, "arrival")), path)
    places = [("changes", _landed_rows(spark, path)), ("quarantine", quarantined_rows(spark, path))]
    first, second = (
        df.select(F.col("wal_pos").alias("lsn"), F.lit(name).alias("where")) for name, df in places
    )
    return first.unionByName(second)


def _landed_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_change_log(spark, path).filter(F.col("kind").isin("I", "U", "D"))


@query(f"""
    WITH {FEED_SQL}, log AS (
      SELECT xid * 8 + 1 + ord AS arrival, lsn AS seen, NULL AS commit_pos FROM feed
      UNION ALL SELECT xid * 8 + 6, commit_pos + 2, commit_pos FROM feed WHERE ord = 0
      UNION ALL SELECT xid * 8 + 7, commit_pos + 400, NULL FROM feed WHERE ord = 0),
    top AS (SELECT max(commit_pos) AS c, arg_max(arrival, commit_pos) AS a FROM log),
    safe AS (SELECT greatest(max(c), coalesce(max(seen) FILTER (arrival > a), 0)) AS lsn FROM log, top)
    SELECT {LSN_SQL} AS confirmed_lsn FROM safe""")
def streamed_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last checkpoint of a capture holds the log's safe position."""
    topic = checkpoint_topic(spark, captured(spark, sf_dir))
    return load_checkpoint(topic).select("confirmed_lsn")


@query(f"""
    SELECT 'public.orders' AS "table", '{{"o_orderkey":' || o_orderkey || '}}' AS key, o_totalprice
    FROM orders
    UNION ALL
    SELECT 'public.conversations', '{{"conv_id":' || conv_id || ',"turn":' || turn || '}}', NULL
    FROM conversations""")
def snapshot_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole snapshot run: a root by its children, a table in key ranges."""
    children = order_children(spark, sf_dir)
    conversations = table(spark, sf_dir, "conversations")
    sources = {**children, "public.conversations": conversations}
    objects = [
        SourceObject("public.orders", "part_root", ("o_orderkey",), tuple(children)),
        SourceObject("public.conversations", "table", ("conv_id", "turn")),
    ]
    folder = new_folder(spark)
    out = f"{folder}/snapshot"
    run_snapshot(spark, objects[:1], sources.__getitem__, out, f"{folder}/state", 2**32)
    waves = max(1, conversations.count() // 3)
    run_snapshot(spark, objects, sources.__getitem__, out, f"{folder}/state", 2**32, waves)
    messages = spark.read.schema(f"{MESSAGE}, topic string, part string").parquet(out)
    price = F.get_json_object("value", "$.o_totalprice").cast("double")
    live = current_table(messages.select("table", "key", "op", "value", "commit_pos", "ord"))
    return live.select("table", "key", price.alias("o_totalprice"))
