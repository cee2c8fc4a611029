"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", name: str = "rowtide") -> SparkSession:
    """A local session for tests and timings; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Methods beyond this size are not compiled by the JVM; Spark then
        # splits the work instead of fusing it.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local master may fall back to a folder of its own machine.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="rowtide-")
    context.setCheckpointDir(path)
    return path


def use_checkpoints(spark: SparkSession) -> None:
    """Point DataFrame.checkpoint() at the shared folder."""
    path = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
