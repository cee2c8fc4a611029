"""Catalog resolution: names to objects, keys, partitions, publications.

Catalogs are usually small, but a dump of many databases need not be, so no
join is forced to broadcast: Spark does that itself below its size threshold
and otherwise shuffles, splitting skewed keys at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.names import name_of, schema_of
from rowtide.schemas import CDC_KINDS, MATVIEW, PART_ROOT, TABLE, VIEW
from rowtide.session import use_checkpoints
from rowtide.sources.catalog import Catalog

# Relation kinds of the system catalog.
RELKINDS = {"r": TABLE, "p": PART_ROOT, "v": VIEW, "m": MATVIEW}


class CatalogError(ValueError):
    """A configured object cannot be captured."""


def object_kind(relkind: Column) -> Column:
    """Kind of object, NULL for an unsupported relkind."""
    kinds = F.create_map(*[F.lit(x) for pair in RELKINDS.items() for x in pair])
    return F.try_element_at(kinds, relkind)


def cdc_capable(kind: Column) -> Column:
    """Tables and partitioned roots have a change log; views do not."""
    return kind.isin(*CDC_KINDS)


def split_views(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects with a change log, views)."""
    capable = cdc_capable(F.col("kind"))
    return objects.filter(capable), objects.filter(~capable)


def relations(catalog: Catalog) -> DataFrame:
    """Every relation with its schema name: `oid, schema, name, relkind`."""
    return (
        catalog["pg_class"]
        .join(
            catalog["pg_namespace"].select(
                F.col("oid").alias("relnamespace"), F.col("nspname").alias("schema")
            ),
            "relnamespace",
        )
        .select("oid", "schema", F.col("relname").alias("name"), "relkind")
    )


def primary_keys(catalog: Catalog) -> DataFrame:
    """`oid, pk_columns`, columns in key order, INCLUDE columns left out."""
    key_size = F.coalesce("indnkeyatts", F.size("indkey"))
    members = (
        catalog["pg_index"]
        .filter("indisprimary")
        .select("indrelid", F.posexplode(F.slice("indkey", F.lit(1), key_size)).alias("pos", "attnum"))
    )
    named = members.join(
        catalog["pg_attribute"].withColumnRenamed("attrelid", "indrelid"),
        ["indrelid", "attnum"],
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "attname")))
    return named.groupBy(F.col("indrelid").alias("oid")).agg(
        F.transform(ordered, lambda m: m["attname"]).alias("pk_columns")
    )


def resolve_objects(names: DataFrame, catalog: Catalog, strict: bool = False) -> DataFrame:
    """Resolve `names(requested)` to objects; `error` says why one cannot be.

    With `strict`, evaluating a row with an error fails the job.
    """
    wanted = names.select(
        "requested",
        schema_of(F.col("requested")).alias("schema"),
        name_of(F.col("requested")).alias("name"),
    )
    found = wanted.join(relations(catalog), ["schema", "name"], "left").withColumn(
        "kind", object_kind(F.col("relkind"))
    )
    keyed = found.join(primary_keys(catalog), "oid", "left")
    no_key = cdc_capable(F.col("kind")) & F.col("pk_columns").isNull()
    error = (
        F.when(F.col("schema").isNull(), "bad_name")
        .when(F.col("oid").isNull(), "not_found")
        .when(F.col("kind").isNull(), "unsupported_kind")
        .when(no_key, "no_primary_key")
    )
    if strict:
        error = F.when(
            error.isNotNull(),
            F.raise_error(F.concat_ws(" ", F.lit("cannot capture"), "requested", error)),
        ).cast("string")
    return keyed.select(
        "requested",
        "oid",
        "schema",
        "name",
        "kind",
        F.when(cdc_capable(F.col("kind")), F.col("pk_columns")).alias("pk_columns"),
        error.alias("error"),
    )


def child_partitions(roots: DataFrame, catalog: Catalog) -> DataFrame:
    """Direct children of `roots(schema, name, pk_columns)`, by name.

    A child takes the root's key and is read as a plain table.
    """
    classes = relations(catalog)
    child = classes.select(
        F.col("oid").alias("inhrelid"),
        F.col("schema").alias("child_schema"),
        F.col("name").alias("child_name"),
    )
    parent = classes.select(F.col("oid").alias("inhparent"), "schema", "name")
    return (
        catalog["pg_inherits"]
        .join(child, "inhrelid")
        .join(parent, "inhparent")
        .join(roots.select("schema", "name", "pk_columns"), ["schema", "name"])
        .select(
            F.concat_ws(".", "schema", "name").alias("root"),
            F.col("child_schema").alias("schema"),
            F.col("child_name").alias("name"),
            F.lit(TABLE).alias("kind"),
            "pk_columns",
        )
        .orderBy("root", "name")
    )


def published(objects: DataFrame, catalog: Catalog) -> DataFrame:
    """The `objects(oid, publication)` that are members of their publication.

    Membership is what the publication itself lists: a leaf listed alone does
    not make its root a member.
    """
    members = (
        catalog["pg_publication_rel"]
        .join(
            catalog["pg_publication"].select(
                F.col("oid").alias("prpubid"), F.col("pubname").alias("publication")
            ),
            "prpubid",
        )
        .select(F.col("prrelid").alias("oid"), "publication")
    )
    return objects.join(members, ["oid", "publication"], "left_semi")


def publication_gap(objects: DataFrame, catalog: Catalog) -> DataFrame:
    """Change-capable `objects(oid, publication, kind, ...)` to be added.

    `action` is `add` to an existing publication or `create` when there is
    none yet.
    """
    capable = objects.filter(cdc_capable(F.col("kind")))
    missing = capable.join(
        published(capable, catalog).select("oid", "publication"), ["oid", "publication"], "left_anti"
    )
    existing = catalog["pg_publication"].select(
        F.col("pubname").alias("publication"), F.lit("add").alias("action")
    )
    return missing.join(existing, "publication", "left").withColumn(
        "action", F.coalesce("action", F.lit("create"))
    )


def publications_without_tables(objects: DataFrame) -> DataFrame:
    """Publications whose configured objects are views only, which is an error."""
    return (
        objects.groupBy("publication")
        .agg(F.count_if(cdc_capable(F.col("kind"))).alias("capable"))
        .filter("capable = 0")
        .select("publication", F.lit("no_cdc_capable_table").alias("error"))
    )


def existing(names: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """The `names` that exist: publications by pubname, slots by slot_name."""
    return names.join(present.select(name), name, "left_semi")


def topmost(edges: DataFrame) -> DataFrame:
    """`child, parent` of every edge, with the topmost ancestor as the parent.

    Each round puts a parent's own parent in its place, which doubles the levels
    that are climbed: the rounds are the logarithm of the deepest level. A cycle
    has no top and is an error.
    """
    climbed = edges.select("child", "parent").distinct()
    if _nested(climbed).isEmpty():
        return climbed
    use_checkpoints(edges.sparkSession)
    climbed = climbed.checkpoint()
    for _ in range(climbed.count().bit_length()):
        above = climbed.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
        climbed = climbed.join(above, "parent", "left").select(
            "child", F.coalesce("above", "parent").alias("parent")
        )
        climbed = climbed.checkpoint()
        if _nested(climbed).isEmpty():
            return climbed
    raise CatalogError("partitions that are their own ancestors")


def _nested(edges: DataFrame) -> DataFrame:
    """Edges whose parent has a parent."""
    return edges.join(edges.select(F.col("child").alias("parent")), "parent", "left_semi")


def leaf_to_root(catalog: Catalog) -> DataFrame:
    """`table, root`: qualified names of partitions and the root they are published as.

    The root is the topmost partitioned table, above any partitions that are
    partitioned themselves.
    """
    classes = relations(catalog)
    qualified = F.concat_ws(".", "schema", "name")
    partitioned = classes.filter("relkind = 'p'").select(F.col("oid").alias("inhparent"))
    edges = catalog["pg_inherits"].join(partitioned, "inhparent", "left_semi")
    tops = topmost(edges.select(F.col("inhrelid").alias("child"), F.col("inhparent").alias("parent")))
    return (
        tops.join(classes.select(F.col("oid").alias("child"), qualified.alias("table")), "child")
        .join(classes.select(F.col("oid").alias("parent"), qualified.alias("root")), "parent")
        .select("table", "root")
    )
