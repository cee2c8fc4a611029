"""The landed change log, as files or as a Kafka topic, in batch or streaming."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.functions.lsn import parse_lsn
from rowtide.operators.decode import with_positions
from rowtide.operators.sizes import broadcast_if_small
from rowtide.schemas import (
    CHANGE_LOG,
    COMMIT_MSG,
    KEEPALIVE_MSG,
    POSITIONED_LOG,
    RELATION_MSG,
    ROW_MSGS,
    SLOT_STATUS,
)
from rowtide.sources.tables import read_if_there


# What a landing did to the safe position, and the pieces (files of changes) it is made of.
LANDING = (
    "landing bigint, generation string, changes bigint, low_commit bigint, top_commit bigint, "
    "seen_after bigint, seen bigint, pieces array<struct<piece:string,low:bigint,high:bigint>>"
)
STORED_LOG = f"{POSITIONED_LOG}, landing bigint, generation string"


def land_change_log(log: DataFrame, path: str) -> int:
    """Append a stretch of the log, with numeric positions, as a numbered landing.

    An attempt that ends before its summary is written leaves rows that no
    landing names; the stretch is then landed again under the same number, as
    another generation. Landings are made one after the other, in log order.
    """
    spark = log.sparkSession
    number = landings(spark, path).agg(F.coalesce(F.max("landing"), F.lit(-1)) + 1).first()[0]
    confirm_landing(spark, path, number, write_landing(log, path, number))
    return number


def write_landing(log: DataFrame, path: str, number: int) -> str:
    """Write the rows of an attempt at a landing, and return its generation.

    Relation messages go to `<path>/relations` first, so that whoever sees a
    change can look up its relation. Keepalives, which belong to no
    transaction, go to `<path>/keepalives`, and rows without a usable position
    to `<path>/quarantine`. The rest goes to `<path>/changes`, clustered by
    commit position: files and row groups cover narrow position ranges, and a
    read from a start position skips what lies before it. Range partitioning
    splits a large transaction by `ord` and needs no key to be evenly spread.

    Every attempt has folders of its own, so that none replaces files which a
    stream may be reading.
    """
    generation = uuid4().hex
    positioned = log if "commit_pos" in log.columns else with_positions(log)
    kind = F.col("kind")
    lost = without_position()
    order = ("commit_pos", "ord", "arrival")
    # Spread by position, then merged to few files by adaptive execution.
    announced = positioned.filter(~lost & (kind == RELATION_MSG)).repartition("commit_pos", "ord")
    changes = positioned.filter(~lost & ~kind.isin(RELATION_MSG, KEEPALIVE_MSG))
    parts = {
        "relations": announced,
        "quarantine": positioned.filter(lost),
        "keepalives": positioned.filter(~lost & (kind == KEEPALIVE_MSG)),
        "changes": changes.repartitionByRange(*order).sortWithinPartitions(*order),
    }
    for name, rows in parts.items():
        _write(rows, _folder(path, name, number, generation))
    return generation


def confirm_landing(spark: SparkSession, path: str, number: int, generation: str) -> None:
    """Write the summary of a whole attempt, which makes it the landing.

    It names the pieces and the positions that each covers. Whoever has read
    these pieces, of this generation, has read the landing; only then does it
    count for the confirmed position.
    """
    rows = spark.createDataFrame([_landing_summary(spark, path, number, generation)], LANDING)
    _write(rows.coalesce(1), f"{path}/landings/landing={number}", drop=("landing",))


def _write(rows: DataFrame, folder: str, drop: tuple[str, ...] = ()) -> None:
    rows.drop(*drop).write.mode("overwrite").parquet(folder)


def _folder(path: str, name: str, number: int, generation: str) -> str:
    return f"{path}/{name}/landing={number}/generation={generation}"


def without_position() -> Column:
    """Rows that cannot be placed: their position is missing or was not readable."""
    is_keepalive = F.col("kind") == KEEPALIVE_MSG
    return F.when(is_keepalive, F.col("end_pos").isNull()).otherwise(F.col("commit_pos").isNull())


def quarantined_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a landed log whose position is missing or malformed."""
    return _confirmed(spark, path, read_if_there(spark, f"{path}/quarantine", STORED_LOG))


def landings(spark: SparkSession, path: str) -> DataFrame:
    """Summaries of the landings that are complete."""
    return read_if_there(spark, f"{path}/landings", LANDING)


def _landing_summary(spark: SparkSession, path: str, number: int, generation: str) -> tuple:
    """What `safe_position` needs of a landing, and its pieces, from its stored files."""
    changes, keepalives_, relations = (
        spark.read.schema(POSITIONED_LOG).parquet(_folder(path, name, number, generation))
        for name in ("changes", "keepalives", "relations")
    )
    seen = F.when(F.col("kind") == KEEPALIVE_MSG, F.col("end_pos")).otherwise(F.col("wal_pos"))
    rows = changes.unionByName(keepalives_).unionByName(relations).withColumn("_seen", seen)
    commit = F.when(F.col("kind") == COMMIT_MSG, F.col("commit_pos"))
    top = rows.agg(F.max(F.struct(commit.alias("c"), (-F.col("arrival")).alias("back"))).alias("t"))
    top_commit, back = top.select("t.c", "t.back").first()
    after = F.lit(True) if top_commit is None else F.col("arrival") > -back
    seen_after, seen_at_all = rows.agg(F.max(F.when(after, F.col("_seen"))), F.max("_seen")).first()
    # One row for each file.
    pieces = (
        changes.groupBy(F.col("_metadata.file_name").alias("piece"))
        .agg(F.min("commit_pos").alias("low"), F.max("commit_pos").alias("high"), F.count("*").alias("rows"))
        .orderBy("low", "piece")
        .collect()
    )
    return (
        number,
        generation,
        sum(p.rows for p in pieces),
        min((p.low for p in pieces), default=None),
        top_commit,
        seen_after,
        seen_at_all,
        [(p.piece, p.low, p.high) for p in pieces],
    )


def landed_relations(spark: SparkSession, path: str) -> DataFrame:
    """Relation messages of a landed log.

    Those of attempts without a summary count too: a stream meets their changes.
    """
    return spark.read.schema(STORED_LOG).parquet(f"{path}/relations").drop("landing", "generation")


def landed_keepalives(spark: SparkSession, path: str) -> DataFrame:
    """Keepalives of a landed log."""
    return _confirmed(spark, path, spark.read.schema(STORED_LOG).parquet(f"{path}/keepalives"))


def _confirmed(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows of the generations that are landings; others were given up and landed again."""
    named = landings(spark, path).select("landing", "generation")
    return rows.join(named, ["landing", "generation"], "left_semi").drop("landing", "generation")


def read_change_log(spark: SparkSession, path: str, start: int | None = None) -> DataFrame:
    """A landed log, from transactions that committed at or after `start`.

    Relation messages and keepalives are read whole: a change needs the
    relation before it, and keepalives belong to no transaction.
    """
    if start is None:
        changes = _confirmed(spark, path, spark.read.schema(STORED_LOG).parquet(f"{path}/changes"))
    else:
        changes = _from_start(_pieces_from(spark, path, start), start)
    return changes.unionByName(landed_relations(spark, path)).unionByName(landed_keepalives(spark, path))


def _pieces_from(spark: SparkSession, path: str, start: int) -> DataFrame:
    """The files of changes that reach a position; only their names pass through the driver."""
    touched = landings(spark, path).select("landing", "generation", F.explode("pieces").alias("p"))
    touched = touched.filter(F.col("p.high") >= start).select("landing", "generation", "p.piece")
    files = sorted(f"{_folder(path, 'changes', r.landing, r.generation)}/{r.piece}" for r in touched.collect())
    if not files:
        return spark.createDataFrame([], POSITIONED_LOG)
    return spark.read.schema(POSITIONED_LOG).parquet(*files)


def stream_change_log(
    spark: SparkSession, path: str, start: int | None = None, files_per_batch: int = 100
) -> DataFrame:
    """The landed changes as a stream, up to `files_per_batch` files at a time.

    Files come in any order, those of attempts without a summary among them: a
    capture that is given the log's `path` confirms a landing when all of its
    pieces have been read. `piece` is a row's file.
    """
    stream = (
        spark.readStream.schema(STORED_LOG)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{path}/changes")
    )
    return _from_start(stream, start).withColumn("piece", F.col("_metadata.file_name"))


def stream_change_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: int | None = None,
    offsets_per_batch: int = 1_000_000,
) -> DataFrame:
    """A log landed on Kafka as JSON; needs Spark's Kafka connector."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_batch)
        .load()
    )
    parsed = records.select(F.from_json(F.col("value").cast("string"), CHANGE_LOG).alias("m"))
    log = with_positions(parsed.select("m.*"))
    # A topic cannot be pruned by position; keepalives have none.
    return log if start is None else log.filter((F.col("commit_pos") >= start) | (F.col("kind") == KEEPALIVE_MSG))


def _from_start(log: DataFrame, start: int | None) -> DataFrame:
    if start is None:
        return log
    # On position alone, so that row groups are skipped by their statistics.
    return log.filter(F.col("commit_pos") >= start)


def published_only(log: DataFrame, published_relations: DataFrame) -> DataFrame:
    """Row changes of published relations, and every other kind of message."""
    rows = log.filter(F.col("kind").isin(*ROW_MSGS)).join(
        broadcast_if_small(published_relations.select("relation_id").distinct()),
        "relation_id",
        "left_semi",
    )
    return log.filter(~F.col("kind").isin(*ROW_MSGS)).unionByName(rows)


def keepalives(log: DataFrame) -> DataFrame:
    """Position-only messages: how far the server is, and whether it waits."""
    return log.filter(F.col("kind") == "K").select("arrival", "end_pos", "reply_requested")


def slot_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sampled slot status."""
    return spark.read.schema(SLOT_STATUS).parquet(path)


def position_of(text: str, spark: SparkSession) -> int:
    """A text position as a number, for use as a job parameter."""
    return spark.range(1).select(parse_lsn(F.lit(text))).first()[0]
