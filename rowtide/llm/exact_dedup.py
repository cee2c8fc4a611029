"""Exact deduplication of a growing table, by a stream with keyed state.

A stream reads the files of a table as they arrive. Its state, kept on disk by
RocksDB and never expired, has one row for each text met so far, keyed by the
digest of the normalised text (without white space): how many rows had it, and
of the row that stays its length, its id and its locator, the file and the row in
it. Copies are combined before the shuffle, so a text that a third of all rows
share reaches its state as one row a task.

A digest met more than once is a hit. The rows of hits are compared byte by byte:
they are grouped by digest and whole normalised text, and the group of the text
that lies at the state's locator is the one the digest stands for. Texts that
share a digest with others, but not their bytes, are told apart by the texts.

The row that stays has the most code points before normalisation, then the
smallest id, then the first file and row. Null texts are empty; rows without an
id stay only if no row as long has one, and name no id as `keep_id`; repeated
rows are copies of each other, of which one stays. An empty table gives no rows.
Other columns are left out. DataFrame functions and Structured Streaming only.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.llm.folders import new_path, stored
from rowtide.operators.sizes import is_small

# Fixed value: the characters that normalisation deletes.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of files in one micro-batch.
BATCH_BYTES = 1 << 40

_STATE = "spark.sql.streaming.stateStore."
SETTINGS = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}rocksdb.boundedMemoryUsage": "true",
    # Files are not allocated ahead: 4 MB for each partition of the state, however small.
    f"{_STATE}rocksdb.allowFAllocate": "false",
}

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    """A text without white space; empty for null."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def arrivals(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """Every row's `digest`, `place` in the order in which rows stay, and normalised `body`."""
    place = F.struct(
        (-F.coalesce(F.char_length("text"), F.lit(0))).alias("shortness"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    rows = docs.select(place.alias("place"), normalised(F.col("text")).alias("body"))
    return rows.select(digest(F.col("body")).alias("digest"), "place", "body")


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """State stores on disk for streams that start inside."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def advance(
    spark: SparkSession, table: str, folder: str, digest: Digest = sha256, batch_bytes: int = BATCH_BYTES
) -> None:
    """Take the table's new files into the state under `folder`, which goes on from call to call."""
    stream = spark.readStream.schema(spark.read.parquet(table).schema)
    # A pattern, as a stream's path may not be a single file.
    rows = arrivals(stream.option("maxBytesPerTrigger", str(batch_bytes)).parquet(_pattern(table)), digest)
    state = rows.groupBy("digest").agg(F.count("*").alias("size"), F.min("place").alias("keep"))
    with disk_state(spark):
        query = (
            state.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", folder)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def states(spark: SparkSession, folder: str) -> DataFrame:
    """`digest`, `size` and `keep` (the place of the row that stays) of every text met."""
    with disk_state(spark):
        state = spark.read.format("statestore").load(folder)
        value = F.col("value")
        return state.select(
            F.col("key.digest").alias("digest"), value["count"].alias("size"), value["min"].alias("keep")
        )


def deduplicate(
    spark: SparkSession, table: str, folder: str | None = None, digest: Digest = sha256
) -> DataFrame:
    """One row for each row of a table: which row stays for it, and of how many.

    `folder` keeps the state; with the same folder, a later call reads the files
    that have been added since and gives all rows anew.
    """
    folder = folder or new_path(spark, "dedup")
    advance(spark, table, folder, digest)
    hits = stored(states(spark, folder).filter("size > 1"), "hits")
    hits = F.broadcast(hits) if is_small(hits) else hits

    rows = arrivals(spark.read.parquet(table), digest)
    apart = stored(_unlike(rows, hits), "unlike")
    named = rows.select("*", F.sha2("body", 256).alias("text_sha256"))
    if apart.isEmpty():
        return _kept(named.drop("body").join(hits, "digest", "left"))
    # Digests that stand for several texts: their rows are grouped by the texts.
    mixed = apart.select("digest").distinct()
    plain = named.drop("body").join(mixed, "digest", "left_anti").join(hits, "digest", "left")
    some = named.join(mixed, "digest", "left_semi")
    groups = some.groupBy("digest", "body").agg(F.count("*").alias("size"), F.min("place").alias("keep"))
    return _kept(plain).unionByName(_kept(some.join(groups, ["digest", "body"])))


def _unlike(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of hits, once for each text that is not the one at the state's locator."""
    met = rows.join(hits, "digest").groupBy("digest", "body")
    kept = met.agg(F.max(F.col("place") == F.col("keep")).alias("kept"))
    return kept.filter("NOT kept").select("digest")


def _kept(rows: DataFrame) -> DataFrame:
    """The result's columns; rows without a partner stay."""
    keep = F.coalesce("keep", "place")
    return rows.select(
        F.col("place.doc_id").alias("doc_id"),
        keep["doc_id"].alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (keep == F.col("place")).alias("kept"),
        "text_sha256",
    )


def _pattern(table: str) -> str:
    head, name = posixpath.split(table.rstrip("/"))
    return posixpath.join(head, f"{name[:-1]}[{name[-1]}]")
