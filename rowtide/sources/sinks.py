"""Writers: messages, dead letters, state log and checkpoint topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.operators.messages import in_wave, kafka_columns, ordered_by_key, position_waves
from rowtide.schemas import MESSAGE, STORED_STATE
from rowtide.sources.tables import read_if_there

# Producer settings of the message topic.
PRODUCER = {
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "100",
    "kafka.batch.size": str(5 * 1024 * 1024),
    "kafka.max.request.size": str(5 * 1024 * 1024),
}


def kafka_available(spark: SparkSession) -> bool:
    """Whether Spark's Kafka connector is on the class path."""
    loader = spark._jvm.Thread.currentThread().getContextClassLoader()
    return loader.getResource("org/apache/spark/sql/kafka010/KafkaSourceProvider.class") is not None


def with_topic(messages: DataFrame, topic: str) -> DataFrame:
    """Name each message's topic: dead letters go to `<topic>-dlq`.

    One write then serves both, so nothing is decoded twice.
    """
    dead = F.col("error").isNotNull()
    return messages.withColumn("topic", F.when(dead, f"{topic}-dlq").otherwise(topic))


def write_message_log(
    messages: DataFrame, path: str, topic: str = "messages", mode: str = "overwrite"
) -> None:
    """Messages as a parquet log, one folder per topic.

    Order is in the `commit_pos, ord` columns, so no shuffle is needed: files
    are written as the rows come.
    """
    with_topic(messages, topic).write.mode(mode).partitionBy("topic").parquet(path)


def read_message_log(spark: SparkSession, path: str, topic: str = "messages") -> DataFrame:
    """Messages of one topic of a parquet log."""
    ddl = f"{MESSAGE}, error string, topic string"
    log = spark.read.schema(ddl).parquet(path)
    return log.filter(F.col("topic") == topic).drop("topic")


def write_message_topic(
    messages: DataFrame,
    servers: str,
    topic: str,
    partitions: int | None = None,
    rows_per_wave: int | None = None,
    topic_partitions: int | None = None,
    **options: str,
) -> None:
    """Messages to Kafka, in log order per key; the key picks the partition.

    A large log is best published in waves of `rows_per_wave`, see
    `position_waves`. View rows all have the key `{}`: given the number of
    partitions of the topic they are spread over all of them by content.
    """
    spread = []
    if topic_partitions:
        place = F.pmod(F.xxhash64("value"), F.lit(topic_partitions)).cast("int")
        spread = [F.when(F.col("key") == "{}", place).alias("partition")]
    waves = [(None, None)] if rows_per_wave is None else position_waves(messages, rows_per_wave)
    for wave in waves:
        part = with_topic(messages.filter(in_wave(wave)), topic)
        (
            ordered_by_key(part, partitions)
            .select("topic", *kafka_columns(), *spread)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("includeHeaders", "true")
            .options(**{**PRODUCER, **options})
            .save()
        )


def append_state(states: DataFrame, path: str) -> None:
    """Append unit states `unit, done, last_pk` to the state log, numbered in order."""
    log = read_if_there(states.sparkSession, path, STORED_STATE)
    seq = log.agg(F.coalesce(F.max("seq"), F.lit(-1)) + 1).first()[0]
    states.select(
        "unit",
        "done",
        "last_pk",
        F.current_timestamp().alias("saved_at"),
        F.lit(seq).cast("bigint").alias("seq"),
    ).coalesce(1).write.mode("append").parquet(path)


def write_checkpoint_topic(record: DataFrame, servers: str, topic: str) -> None:
    """A checkpoint record to its topic, always to the record's partition 0."""
    (
        record.select("partition", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .save()
    )


def append_checkpoint(record: DataFrame, path: str, offset: int) -> None:
    """The same record to a file log; one folder per offset makes a rerun safe."""
    record.withColumn("offset", F.lit(offset).cast("bigint")).select(
        "partition", "offset", "key", "value"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/at={offset}")
