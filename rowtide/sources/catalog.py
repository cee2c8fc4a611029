"""Catalog dumps: one frame per system table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowtide.schemas import CATALOG

Catalog = Mapping[str, DataFrame]


def read_catalog(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A dumped catalog: `<folder>/<system table>` as parquet."""
    return {
        table: spark.read.schema(ddl).parquet(f"{folder}/{table}")
        for table, ddl in CATALOG.items()
    }


def read_catalog_jdbc(spark: SparkSession, **options: str) -> dict[str, DataFrame]:
    """The same frames over JDBC, each system table read with its needed columns."""
    queries = {
        "pg_namespace": "SELECT oid::bigint AS oid, nspname FROM pg_namespace",
        "pg_class": (
            "SELECT oid::bigint AS oid, relnamespace::bigint AS relnamespace, relname, "
            "relkind::text AS relkind FROM pg_class"
        ),
        "pg_index": (
            "SELECT indrelid::bigint AS indrelid, indkey::int[] AS indkey, "
            "indnkeyatts::int AS indnkeyatts, indisprimary FROM pg_index"
        ),
        "pg_attribute": (
            "SELECT attrelid::bigint AS attrelid, attnum::int AS attnum, attname "
            "FROM pg_attribute WHERE attnum > 0"
        ),
        "pg_inherits": (
            "SELECT inhrelid::bigint AS inhrelid, inhparent::bigint AS inhparent FROM pg_inherits"
        ),
        "pg_publication": "SELECT oid::bigint AS oid, pubname FROM pg_publication",
        "pg_publication_rel": (
            "SELECT prpubid::bigint AS prpubid, prrelid::bigint AS prrelid FROM pg_publication_rel"
        ),
        "pg_replication_slots": (
            "SELECT slot_name, confirmed_flush_lsn::text AS confirmed_flush_lsn "
            "FROM pg_replication_slots"
        ),
    }
    return {
        table: spark.read.format("jdbc").options(**options).option("query", query).load()
        for table, query in queries.items()
    }
