"""Catalog resolution over a catalog derived from customers and orders.

Nations are schemas, customers are relations whose kind follows the market
segment, orders are the child partitions of their customer, regions own the
publications. So the catalog grows with the data, and a customer with many
orders is a root with many partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.operators.catalog import (
    child_partitions,
    existing,
    leaf_to_root,
    primary_keys,
    publication_gap,
    publications_without_tables,
    published,
    resolve_objects,
    split_views,
)
from rowtide.queries.registry import query, table

ORDER_OID = 10**9

SEGMENT_KIND_SQL = """CASE c_mktsegment WHEN 'BUILDING' THEN 'r' WHEN 'AUTOMOBILE' THEN 'p'
      WHEN 'MACHINERY' THEN 'v' WHEN 'HOUSEHOLD' THEN 'm' ELSE 'f' END"""

# Objects asked for: every customer, every supplier (none exists) and every
# part's name, which is no qualified name.
OBJECTS_SQL = f"""objects AS (
    SELECT c_custkey AS oid, 's' || c_nationkey AS "schema", c_name AS name,
      {SEGMENT_KIND_SQL} AS relkind, c_acctbal >= 0 AS has_key, c_nationkey,
      CASE c_custkey % 3 WHEN 0 THEN 'id' WHEN 1 THEN 'region,id' ELSE 'at,id' END AS pk
    FROM customer),
  kinds AS (
    SELECT *, CASE relkind WHEN 'r' THEN 'table' WHEN 'p' THEN 'part_root'
      WHEN 'v' THEN 'view' WHEN 'm' THEN 'matview' END AS kind FROM objects)"""


def derived_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    relkind = (
        F.when(F.col("c_mktsegment") == "BUILDING", "r")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "p")
        .when(F.col("c_mktsegment") == "MACHINERY", "v")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "m")
        .otherwise("f")
    )
    named = customers.select(
        F.col("c_custkey").alias("oid"),
        F.col("c_nationkey").cast("bigint").alias("relnamespace"),
        F.col("c_name").alias("relname"),
        relkind.alias("relkind"),
    )
    leaves = orders.select(
        (F.col("o_orderkey") + ORDER_OID).alias("oid"),
        (F.col("o_orderkey") % 25).alias("relnamespace"),
        F.concat(F.lit("leaf_"), "o_orderkey").alias("relname"),
        F.lit("r").alias("relkind"),
    )
    key = F.col("c_custkey") % 3
    # The last attribute of a three-part index is an INCLUDE column.
    indkey = (
        F.when(key == 0, F.array(F.lit(1)))
        .when(key == 1, F.array(F.lit(2), F.lit(1)))
        .otherwise(F.array(F.lit(3), F.lit(1), F.lit(2)))
    )
    attributes = F.array(
        *[
            F.struct(F.lit(i + 1).alias("attnum"), F.lit(n).alias("attname"))
            for i, n in enumerate(("id", "region", "at"))
        ]
    )
    regions = table(spark, sf_dir, "region")
    members = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("bigint").alias("prpubid")
    )
    return {
        "pg_namespace": table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("oid"),
            F.concat(F.lit("s"), "n_nationkey").alias("nspname"),
        ),
        "pg_class": named.unionByName(leaves),
        "pg_index": customers.select(
            F.col("c_custkey").alias("indrelid"),
            indkey.alias("indkey"),
            F.least(F.size(indkey), F.lit(2)).alias("indnkeyatts"),
            (F.col("c_acctbal") >= 0).alias("indisprimary"),
        ),
        "pg_attribute": customers.select(
            F.col("c_custkey").alias("attrelid"), F.inline(attributes)
        ),
        "pg_inherits": orders.select(
            (F.col("o_orderkey") + ORDER_OID).alias("inhrelid"),
            F.col("o_custkey").alias("inhparent"),
        ),
        "pg_publication": regions.filter("r_name <> 'ASIA'").select(
            F.col("r_regionkey").cast("bigint").alias("oid"),
            F.concat(F.lit("pub_"), "r_name").alias("pubname"),
        ),
        "pg_publication_rel": customers.join(members, "c_custkey", "left_semi")
        .join(nations, "c_nationkey")
        .select("prpubid", F.col("c_custkey").alias("prrelid")),
    }


def requested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("s"), "c_nationkey", F.lit("."), "c_name").alias("requested")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), "s_nationkey", F.lit("."), "s_name").alias("requested")
    )
    parts = table(spark, sf_dir, "part").select(
        F.concat("p_name", F.lit(" "), "p_partkey").alias("requested")
    )
    return customers.unionByName(suppliers).unionByName(parts)


def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved customers with the publication of their region."""
    resolved = resolve_objects(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("s"), "c_nationkey", F.lit("."), "c_name").alias("requested")
        ),
        derived_catalog(spark, sf_dir),
    ).filter("error IS NULL")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    owner = nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.concat(F.lit("s"), "n_nationkey").alias("schema"),
        F.concat(F.lit("pub_"), "r_name").alias("publication"),
    )
    return resolved.join(owner, "schema")


CONFIGURED_SQL = f"""{OBJECTS_SQL},
  configured AS (
    SELECT k.*, 'pub_' || r_name AS publication, n_regionkey,
      EXISTS (SELECT 1 FROM orders WHERE o_custkey = k.oid AND o_orderstatus = 'F')
        AND r_name <> 'ASIA' AS member, r_name <> 'ASIA' AS pub_exists
    FROM kinds k JOIN nation ON n_nationkey = k.c_nationkey
      JOIN region ON r_regionkey = n_regionkey
    WHERE kind IN ('view', 'matview') OR (kind IN ('table', 'part_root') AND has_key))"""


@query(f"""
    WITH {OBJECTS_SQL}
    SELECT "schema" || '.' || name AS requested, kind,
      CASE WHEN kind IN ('table', 'part_root') AND has_key THEN pk END AS pk,
      CASE WHEN kind IS NULL THEN 'unsupported_kind'
        WHEN kind IN ('table', 'part_root') AND NOT has_key THEN 'no_primary_key' END AS error
    FROM kinds
    UNION ALL
    SELECT 's' || s_nationkey || '.' || s_name, NULL, NULL, 'not_found' FROM supplier
    UNION ALL
    SELECT p_name || ' ' || p_partkey, NULL, NULL, 'bad_name' FROM part""")
def catalog_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to objects; every way a name can fail is told apart."""
    resolved = resolve_objects(requested_names(spark, sf_dir), derived_catalog(spark, sf_dir))
    return resolved.select(
        "requested", "kind", F.array_join("pk_columns", ",").alias("pk"), "error"
    )


@query(f"""
    WITH {OBJECTS_SQL}
    SELECT oid, pk FROM objects WHERE has_key""")
def pk_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns in key order, INCLUDE columns left out."""
    keys = primary_keys(derived_catalog(spark, sf_dir))
    return keys.select("oid", F.array_join("pk_columns", ",").alias("pk"))


@query(f"""
    WITH {OBJECTS_SQL}
    SELECT "schema" || '.' || name AS root, 's' || (o_orderkey % 25) AS "schema",
      'leaf_' || o_orderkey AS name, 'table' AS kind, pk
    FROM kinds JOIN orders ON o_custkey = oid WHERE kind = 'part_root' AND has_key""")
def child_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of every partitioned root, with the root's key."""
    roots = configured(spark, sf_dir).filter("kind = 'part_root'")
    children = child_partitions(roots, derived_catalog(spark, sf_dir))
    return children.select("root", "schema", "name", "kind", F.array_join("pk_columns", ",").alias("pk"))


@query(f"""
    WITH {OBJECTS_SQL}
    SELECT 's' || (o_orderkey % 25) || '.leaf_' || o_orderkey AS "table",
      "schema" || '.' || name AS root
    FROM kinds JOIN orders ON o_custkey = oid WHERE kind = 'part_root'""")
def leaf_root_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root each leaf is published as."""
    return leaf_to_root(derived_catalog(spark, sf_dir))


TREE_OID = 2 * 10**9


def tree_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Regions as roots, nations and customers as partitions that are partitioned, orders as leaves."""
    levels = [
        ("region", "r_regionkey", TREE_OID + 1000, None, None, "p"),
        ("nation", "n_nationkey", TREE_OID, "n_regionkey", TREE_OID + 1000, "p"),
        ("customer", "c_custkey", 0, "c_nationkey", TREE_OID, "p"),
        ("orders", "o_orderkey", ORDER_OID, "o_custkey", 0, "r"),
    ]
    classes, edges = [], []
    for name, key, base, up, up_base, relkind in levels:
        rows = table(spark, sf_dir, name)
        oid = (F.col(key).cast("bigint") + base).alias("oid")
        relname = F.concat(F.lit(f"{name}_"), key).alias("relname")
        classes.append(rows.select(oid, F.lit(0).alias("relnamespace"), relname, F.lit(relkind).alias("relkind")))
        if up is not None:
            parent = (F.col(up).cast("bigint") + up_base).alias("inhparent")
            edges.append(rows.select(oid.alias("inhrelid"), parent))
    return {
        "pg_namespace": spark.range(1).select(F.col("id").alias("oid"), F.lit("public").alias("nspname")),
        "pg_class": reduce(DataFrame.unionByName, classes),
        "pg_inherits": reduce(DataFrame.unionByName, edges),
    }


@query("""
    WITH c AS (
      SELECT c_custkey, c_nationkey, 'public.region_' || n_regionkey AS root
      FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT 'public.orders_' || o_orderkey AS "table", root FROM orders JOIN c ON c_custkey = o_custkey
    UNION ALL SELECT 'public.customer_' || c_custkey, root FROM c
    UNION ALL SELECT 'public.nation_' || n_nationkey, 'public.region_' || n_regionkey FROM nation""")
def nested_root_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topmost root of every partition, three levels below it at most."""
    return leaf_to_root(tree_catalog(spark, sf_dir))


@query(f"""
    WITH {CONFIGURED_SQL}
    SELECT oid, publication, "schema" || '.' || name AS requested FROM configured WHERE member""")
def publication_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured objects that their publication already lists."""
    members = published(configured(spark, sf_dir), derived_catalog(spark, sf_dir))
    return members.select("oid", "publication", "requested")


@query(f"""
    WITH {CONFIGURED_SQL}
    SELECT oid, publication, kind, CASE WHEN pub_exists THEN 'add' ELSE 'create' END AS action
    FROM configured WHERE kind IN ('table', 'part_root') AND NOT member""")
def publication_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that have to be added, or their publication created."""
    gap = publication_gap(configured(spark, sf_dir), derived_catalog(spark, sf_dir))
    return gap.select("oid", "publication", "kind", "action")


@query(f"""
    WITH {OBJECTS_SQL}
    SELECT 'c' || (oid // 2) AS publication, 'no_cdc_capable_table' AS error
    FROM kinds WHERE kind IS NOT NULL GROUP BY 1
    HAVING count(*) FILTER (kind IN ('table', 'part_root')) = 0""")
def publications_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications that would hold no table at all."""
    resolved = resolve_objects(
        requested_names(spark, sf_dir), derived_catalog(spark, sf_dir)
    ).filter("kind IS NOT NULL")
    return publications_without_tables(
        resolved.withColumn("publication", F.concat(F.lit("c"), F.expr("oid div 2")))
    )


@query(f"""
    WITH {CONFIGURED_SQL}
    SELECT publication, kind IN ('table', 'part_root') AS captured, count(*) AS objects
    FROM configured GROUP BY ALL""")
def capable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with a change log and views, apart."""
    captured, views = split_views(configured(spark, sf_dir))
    both = captured.withColumn("captured", F.lit(True)).unionByName(
        views.withColumn("captured", F.lit(False))
    )
    return both.groupBy("publication", "captured").agg(F.count("*").alias("objects"))


@query("""
    SELECT 'slot_' || user_id AS slot_name FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer)
    GROUP BY user_id""")
def existing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted slots that exist, one for every customer."""
    customers = table(spark, sf_dir, "customer")
    wanted = customers.select(F.concat(F.lit("slot_"), "c_custkey").alias("slot_name"))
    slots = table(spark, sf_dir, "events").select(F.concat(F.lit("slot_"), "user_id").alias("slot_name"))
    return existing(wanted, slots, "slot_name")
