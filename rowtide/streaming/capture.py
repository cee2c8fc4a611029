"""Continuous capture: a change-log stream to messages, with progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.decode import decode_changes
from rowtide.operators.messages import MESSAGE_COLUMNS
from rowtide.operators.progress import checkpoint_record, safe_position
from rowtide.operators.relations import History, described_versions, relation_versions
from rowtide.plans.snapshot import read_state
from rowtide.schemas import MESSAGE, RELATION
from rowtide.sources.change_log import landings, published_only
from rowtide.sources.sinks import append_checkpoint, write_message_log
from rowtide.sources.tables import read_if_there

_HISTORY = f"relation_id bigint, relation {RELATION}, valid_from struct<commit_pos:bigint,ord:bigint>"
_PROGRESS = (
    "slot_name string, safe_pos bigint, last_commit bigint, landings bigint, pieces map<bigint,array<string>>"
)


def start_capture(
    log: DataFrame,
    folder: str,
    slot: str,
    start: int = 0,
    relations: Callable[[], DataFrame] | None = None,
    pk: DataFrame | None = None,
    roots: DataFrame | None = None,
    state: str | None = None,
    old_key_tombstones: bool = True,
    interval: str | None = None,
    path: str | None = None,
    strict: bool = False,
    published: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Decode a change-log stream into `<folder>/messages`.

    Every micro-batch writes folders named by its number and overwrites them
    when it is repeated, so a batch that failed half-way leaves nothing behind.
    Publishing comes before progress: a restart may resend, never skip. Without
    an `interval` the stream takes what is there and stops.

    Relation messages in the stream are remembered; `relations` reads those
    that were landed apart from it. `state` is a snapshot's state log, whose
    unit states go into the checkpoint records. `published` reads the relations
    of the publication, others are left out; `strict` stops the stream, before
    any progress, at a change of an unknown relation.

    `path` is the landed log that the stream reads. Its files come in any
    order, so the confirmed position follows whole landings: it moves over a
    landing when all its changes, and those of all landings before, have been
    published, and stays below the lowest commit of what is not. Without `path`
    the rows must come in the order of their arrival, as from one topic partition.
    """

    prepared = _Prepared()

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        _remember_relations(rows, folder, batch_id)
        history = _remembered(spark, folder, batch_id)
        if relations is not None:
            history = history.unionByName(relation_versions(relations()))
        wanted = rows if published is None else published_only(rows, published())
        known = prepared.of(described_versions(history, pk, roots))
        messages = decode_changes(wanted, old_key_tombstones=old_key_tombstones, strict=strict, known=known)
        write_message_log(
            messages.select(*MESSAGE_COLUMNS, "error"), f"{folder}/messages/batch={batch_id}"
        )
        _save_progress(spark, rows, folder, slot, start, state, batch_id, path)

    writer = (
        log.writeStream.foreachBatch(batch)
        .option("checkpointLocation", f"{folder}/offsets")
        .queryName(f"capture-{slot}")
    )
    timed = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return timed.start()


class _Prepared:
    """The relation history of the batch before, prepared again only when its rows changed."""

    def __init__(self):
        self.digest: tuple | None = None
        self.history: History | None = None

    def of(self, versions: DataFrame) -> History:
        row = F.xxhash64(*[F.col(c) for c in versions.columns]).cast("decimal(38,0)")
        digest = tuple(versions.agg(F.count("*"), F.sum(row)).first())
        if self.history is None or digest != self.digest:
            self.digest, self.history = digest, History(versions)
        return self.history


def _remember_relations(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Later batches need the versions announced in this one."""
    announced = relation_versions(rows)
    if not announced.isEmpty():
        spread = announced.repartition("valid_from")
        spread.write.mode("overwrite").parquet(f"{folder}/relations/batch={batch_id}")


def _remembered(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """Versions of this and earlier batches; later ones are left from a lost run."""
    stored = read_if_there(spark, f"{folder}/relations", f"{_HISTORY}, batch bigint")
    return stored.filter(F.col("batch") <= batch_id).drop("batch")


def _save_progress(
    spark: SparkSession,
    rows: DataFrame,
    folder: str,
    slot: str,
    start: int,
    state: str | None,
    batch_id: int,
    path: str | None,
) -> None:
    """Safe position after the batch, and the checkpoint record with it."""
    begin = Row(slot_name=slot, safe_pos=start, last_commit=start, landings=-1, pieces={})
    if batch_id > 0:
        begin = spark.read.schema(_PROGRESS).parquet(f"{folder}/progress/batch={batch_id - 1}").first()
    if path is None:
        starts = spark.createDataFrame(
            [(slot, begin.safe_pos, begin.last_commit)], "slot_name string, start_pos bigint, last_commit bigint"
        )
        reached = safe_position(rows.withColumn("slot_name", F.lit(slot)), starts).first()
        progress = (slot, reached.safe_pos, reached.last_commit, -1, {})
    else:
        progress = _over_landings(spark, rows, path, begin, start)
    spark.createDataFrame([progress], _PROGRESS).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/progress/batch={batch_id}"
    )
    units = spark.createDataFrame([], "unit string, done boolean, last_pk string")
    if state is not None:
        units = read_state(spark, state)
    safe = progress[1]
    confirmed = f"{safe >> 32:X}/{safe & 0xFFFFFFFF:X}"
    append_checkpoint(checkpoint_record(units, confirmed), f"{folder}/checkpoint", batch_id)


def _over_landings(spark: SparkSession, rows: DataFrame, path: str, begin: Row, start: int) -> tuple:
    """Progress after a batch of a landed log.

    `pieces` holds the files published of landings that are not yet whole; these
    are few, as files are taken about in the order they were landed. Files of an
    attempt that was given up are in no summary, so the repeated landing counts
    as whole with its own files alone. A reader that starts at a position needs
    only the files that reach it.
    """
    read = {landing: set(files) for landing, files in begin.pieces.items()}
    # A batch has a bounded number of files.
    for landing, piece in rows.select("landing", "piece").distinct().collect():
        read.setdefault(landing, set()).add(piece)
    safe, last, done = begin.safe_pos, begin.last_commit, begin.landings
    waiting = landings(spark, path).filter(F.col("landing") > done).orderBy("landing")
    low = None
    for landing in waiting.toLocalIterator():
        wanted = {p.piece for p in landing.pieces if p.high >= start}
        if landing.landing == done + 1 and low is None and wanted <= read.get(landing.landing, set()):
            read.pop(landing.landing, None)
            done = landing.landing
            if landing.top_commit is not None and landing.top_commit > last:
                safe, last = landing.top_commit, landing.top_commit
                safe = max(safe, landing.seen_after or 0)
            else:
                safe = max(safe, landing.seen or 0)
        elif landing.low_commit is not None:
            low = landing.low_commit if low is None else min(low, landing.low_commit)
    # What is confirmed never passes a commit that is still to be published,
    # nor falls behind what was confirmed before.
    confirmed = safe if low is None else max(begin.safe_pos, min(safe, low))
    # Files of a landing that is whole come again only where an attempt was given up.
    waiting_files = {landing: sorted(files) for landing, files in read.items() if landing > done}
    return (begin.slot_name, confirmed, last, done, waiting_files)


def captured_messages(spark: SparkSession, folder: str, topic: str = "messages") -> DataFrame:
    """Messages a capture has written so far, resent ones included."""
    ddl = f"{MESSAGE}, error string, batch bigint, topic string"
    log = spark.read.schema(ddl).parquet(f"{folder}/messages")
    return log.filter(F.col("topic") == topic).drop("topic", "batch")


def checkpoint_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Checkpoint records a capture has written so far."""
    ddl = "partition int, offset bigint, key string, value string"
    return spark.read.schema(ddl).parquet(f"{folder}/checkpoint")


def stream_messages(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The captured messages as a stream, for consumers."""
    ddl = f"{MESSAGE}, error string, batch bigint, topic string"
    return (
        spark.readStream.schema(ddl)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/messages")
        .filter("topic = 'messages'")
        .select(*MESSAGE_COLUMNS)
    )
