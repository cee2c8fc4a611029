"""Readers of source tables, and a pinned read point for all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

# Listings after which tables that never stop growing are given up.
MOST_LISTINGS = 100


def read_if_there(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A parquet folder, or no rows where the folder does not exist yet.

    Only a missing path counts as nothing; any other fault is raised.
    """
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def read_versioned(
    spark: SparkSession, path: str, version: int | str, table_format: str = "delta"
) -> DataFrame:
    """A table of a versioned format at one version, for every reader alike."""
    return spark.read.format(table_format).option("versionAsOf", version).load(path)


def pin_files(spark: SparkSession, path: str, manifest: str) -> None:
    """Freeze the files a parquet table consists of now, as a manifest table.

    Readers of the manifest see the same rows however often, and wherever,
    they read, as long as files are only added. The files are listed, not read.
    """
    files = [(path, name) for name in spark.read.parquet(path).inputFiles()]
    spark.createDataFrame(files, "base string, file_path string").repartition(1).write.mode(
        "overwrite"
    ).parquet(manifest)


def read_pinned(spark: SparkSession, manifest: str) -> DataFrame:
    """The table a manifest pins, with its partition columns.

    Only file names pass through the driver, as for any listed folder.
    """
    rows = spark.read.parquet(manifest).collect()
    # Listed names are URIs; readers take plain paths.
    paths = sorted(unquote(r.file_path) for r in rows)
    return spark.read.option("basePath", rows[0].base).parquet(*paths)


def pin_cycle(spark: SparkSession, tables: Mapping[str, str], folder: str, cycle_id: int) -> None:
    """One read point for several parquet tables, `name: path`.

    The tables are listed one after the other until two rounds of listings in
    a row agree: as files are only added, all tables then looked like this at the
    time between the two rounds. The manifest is one file, written under
    `folder/cycle=<id>`; it counts once its job has been committed, and a cycle
    that has one keeps it, so that a repeated cycle reads what the first did.
    """
    if cycle_is_pinned(spark, folder, cycle_id):
        return
    before = None
    for _ in range(MOST_LISTINGS):
        listed = [
            (name, path, file)
            for name, path in sorted(tables.items())
            for file in sorted(spark.read.parquet(path).inputFiles())
        ]
        if listed == before:
            break
        before = listed
    else:
        raise RuntimeError("the tables changed during every listing")
    ddl = "table string, base string, file_path string"
    spark.createDataFrame(listed, ddl).repartition(1).write.mode("overwrite").parquet(
        f"{folder}/cycle={cycle_id}"
    )


def cycle_is_pinned(spark: SparkSession, folder: str, cycle_id: int) -> bool:
    """Whether a cycle's manifest was written to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/cycle={cycle_id}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_cycle(spark: SparkSession, folder: str, cycle_id: int, table: str) -> DataFrame:
    """A table as its cycle pinned it."""
    if not cycle_is_pinned(spark, folder, cycle_id):
        raise ValueError(f"cycle {cycle_id} has no read point")
    pinned = spark.read.parquet(f"{folder}/cycle={cycle_id}").filter(F.col("table") == table)
    rows = pinned.collect()
    if not rows:
        raise ValueError(f"table {table} is not in cycle {cycle_id}")
    paths = sorted(unquote(r.file_path) for r in rows)
    return spark.read.option("basePath", rows[0].base).parquet(*paths)


def jdbc_options(
    url: str,
    table: str,
    fetch_size: int = 1000,
    exported_snapshot: str | None = None,
    **connection: str,
) -> dict[str, str]:
    """Options of a JDBC snapshot read.

    With an exported snapshot each of Spark's connections joins it before it
    reads, so that all partitions see one consistent point. A fetch size makes
    the driver open the transaction that these settings apply to.
    """
    if fetch_size < 1:
        raise ValueError("fetch size must be positive")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if exported_snapshot is not None:
        if "'" in exported_snapshot:
            raise ValueError("bad snapshot name")
        options["sessionInitStatement"] = (
            "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ READ ONLY; "
            f"SET TRANSACTION SNAPSHOT '{exported_snapshot}'"
        )
    return options


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    split_column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
    predicates: Sequence[str] = (),
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table over JDBC, read in parallel by key range or by predicates."""
    if predicates:
        extra = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(
            options["url"],
            options["dbtable"],
            predicates=list(predicates),
            properties={**extra, **(properties or {})},
        )
    reader = spark.read.format("jdbc").options(**options)
    if split_column is not None:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()
