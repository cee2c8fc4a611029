"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from rowtide.session import shared_dir


#: Shuffle partitions whose rows share a file of a small table.
PARTITIONS_A_FILE = 32


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame written once and read back, which cuts its lineage.

    The files are in the shared folder, so a lost executor loses none of them.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(spark: SparkSession) -> int:
    """Files for a table that is small beside what it is made of: a part of the shuffle's, one a core at least.

    A file costs its task a commit and, where Hadoop has no native library, processes
    that the executor's JVM starts to set permissions.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, max(spark.sparkContext.defaultParallelism, partitions // PARTITIONS_A_FILE)))
