"""A table kept current from a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.state import current_table, newest_per_key
from rowtide.schemas import DELETE, MESSAGE


def start_table(messages: DataFrame, folder: str, interval: str | None = None) -> StreamingQuery:
    """Keep the newest message per key of a message stream under `folder`.

    Each micro-batch is reduced to one row per key and stored beside the
    others; readers take the newest over all of them. No batch rewrites the
    table, a repeated batch replaces itself, and a message that arrives late
    or twice changes nothing.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        newest_per_key(rows).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(batch).option(
        "checkpointLocation", f"{folder}/offsets"
    )
    timed = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return timed.start()


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MESSAGE}, batch bigint").parquet(f"{folder}/rows").drop("batch")


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """Live rows of the table now."""
    return current_table(_stored(spark, folder))


def fold_table(spark: SparkSession, folder: str, target: str) -> None:
    """The stored batches as one, in a new folder.

    Tombstones stay, so that an old message that is sent again cannot bring a
    deleted row back. Batches -1 in the target sort before any later one.
    """
    folded = newest_per_key(_stored(spark, folder))
    folded.write.mode("overwrite").parquet(f"{target}/rows/batch=-1")


def live_rows(messages: DataFrame) -> DataFrame:
    """The same reduction as a streaming aggregate, for `update` or `complete`
    output; its state is the table itself."""
    return newest_per_key(messages).filter(F.col("op") != DELETE)
