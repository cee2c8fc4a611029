from __future__ import annotations

import pytest

from conftest import rows
from rowtide.operators.catalog import (
    CatalogError,
    child_partitions,
    existing,
    leaf_to_root,
    publication_gap,
    publications_without_tables,
    published,
    resolve_objects,
    split_views,
    topmost,
)
from rowtide.schemas import CATALOG
from rowtide.sources.catalog import read_catalog


@pytest.fixture(scope="module")
def catalog(spark):
    data = {
        "pg_namespace": [(1, "public"), (2, "Other")],
        "pg_class": [
            (10, 1, "orders", "r"),
            (11, 1, "items", "p"),
            (12, 1, "totals", "v"),
            (13, 2, "cache", "m"),
            (14, 1, "remote", "f"),
            (15, 1, "nokey", "r"),
            (16, 1, "items_b", "r"),
            (17, 2, "items_a", "r"),
            (18, 1, "empty_root", "p"),
            (19, 1, "items_sub", "r"),
            (20, 1, "odd.name", "r"),
        ],
        "pg_index": [
            (10, [1], 1, True),
            (10, [2], 1, False),
            (11, [3, 1, 2], 2, True),
            (15, [1], 1, False),
            (18, [1], None, True),
            (20, [1], 1, True),
        ],
        "pg_attribute": [(o, n, c) for o in (10, 11, 15, 18, 20) for n, c in ((1, "id"), (2, "x"), (3, "at"))],
        "pg_inherits": [(16, 11), (17, 11), (19, 16)],
        "pg_publication": [(100, "pub")],
        "pg_publication_rel": [(100, 10), (100, 16)],
        "pg_replication_slots": [("slot", "0/10")],
    }
    return {t: spark.createDataFrame(data[t], ddl) for t, ddl in CATALOG.items()}


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "requested string")


def test_resolution(spark, catalog):
    got = resolve_objects(
        names(
            spark,
            "public.orders",
            "public.items",
            "public.totals",
            "Other.cache",
            "other.cache",
            "public.remote",
            "public.nokey",
            "public.odd.name",
            "orders",
            ".x",
        ),
        catalog,
    )
    found = {r.requested: (r.kind, r.pk_columns, r.error) for r in got.collect()}
    assert found == {
        "public.orders": ("table", ["id"], None),
        "public.items": ("part_root", ["at", "id"], None),
        "public.totals": ("view", None, None),
        "Other.cache": ("matview", None, None),
        "other.cache": (None, None, "not_found"),
        "public.remote": (None, None, "unsupported_kind"),
        "public.nokey": ("table", None, "no_primary_key"),
        "public.odd.name": ("table", ["id"], None),
        "orders": (None, None, "bad_name"),
        ".x": (None, None, "bad_name"),
    }
    captured, views = split_views(got.filter("error IS NULL"))
    assert (captured.count(), views.count()) == (3, 2)


def test_strict_resolution_fails(spark, catalog):
    with pytest.raises(Exception, match="not_found"):
        resolve_objects(names(spark, "public.gone"), catalog, strict=True).collect()
    assert resolve_objects(names(spark, "public.orders"), catalog, strict=True).count() == 1


def test_direct_children_in_name_order(spark, catalog):
    roots = resolve_objects(names(spark, "public.items", "public.empty_root"), catalog)
    children = child_partitions(roots, catalog).collect()
    assert [(c.root, c.schema, c.name, c.kind, c.pk_columns) for c in children] == [
        ("public.items", "Other", "items_a", "table", ["at", "id"]),
        ("public.items", "public", "items_b", "table", ["at", "id"]),
    ]


def test_leaf_listed_alone_does_not_make_its_root_a_member(spark, catalog):
    objects = resolve_objects(names(spark, "public.orders", "public.items", "public.totals"), catalog)
    from pyspark.sql import functions as F

    mine = objects.withColumn("publication", F.lit("pub"))
    assert rows(published(mine, catalog), "requested") == [("public.orders",)]
    assert rows(publication_gap(mine, catalog), "requested", "action") == [("public.items", "add")]
    new = objects.withColumn("publication", F.lit("new"))
    assert rows(publication_gap(new, catalog), "requested", "action") == [
        ("public.items", "create"),
        ("public.orders", "create"),
    ]
    assert publications_without_tables(mine).count() == 0
    views = mine.filter("kind = 'view'")
    assert rows(publications_without_tables(views)) == [("pub", "no_cdc_capable_table")]


def test_leaf_map_and_existence(spark, catalog):
    assert rows(leaf_to_root(catalog)) == [
        ("Other.items_a", "public.items"),
        ("public.items_b", "public.items"),
    ]
    wanted = spark.createDataFrame([("slot",), ("gone",)], "slot_name string")
    assert rows(existing(wanted, catalog["pg_replication_slots"], "slot_name")) == [("slot",)]


def test_topmost(spark):
    """A deep chain, two trees, repeated edges; a cycle is an error."""
    chain = [(i, i + 1) for i in range(20)]
    trees = [(100, 200), (101, 200), (200, 300), (102, 300), (100, 200), (400, 401)]
    edges = spark.createDataFrame(chain + trees, "child bigint, parent bigint")
    want = [(i, 20) for i in range(20)] + [(100, 300), (101, 300), (102, 300), (200, 300), (400, 401)]
    assert rows(topmost(edges), "child", "parent") == sorted(want, key=repr)
    assert topmost(edges.limit(0)).isEmpty()
    for cycle in ([(1, 1)], [(1, 2), (2, 3), (3, 1), (4, 1)]):
        with pytest.raises(CatalogError, match="ancestors"):
            topmost(spark.createDataFrame(cycle, "child bigint, parent bigint"))


def test_catalog_dump(spark, catalog, tmp_path):
    for table, df in catalog.items():
        df.write.parquet(f"{tmp_path}/{table}")
    dumped = read_catalog(spark, str(tmp_path))
    assert rows(leaf_to_root(dumped)) == rows(leaf_to_root(catalog))
