"""Snapshot scans, pages and ranges."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rowtide.functions.keyset import last_cursor, read_cursor
from rowtide.functions.names import route
from rowtide.operators.messages import row_messages
from rowtide.operators.monitor import rows_by_partition
from rowtide.operators.snapshot import (
    between,
    keyset_page,
    page_cursors,
    page_plan,
    range_pages,
    range_units,
    refresh_views,
    snapshot_partitioned,
    snapshot_table,
    snapshot_view,
)
from rowtide.plans.snapshot import SourceObject, read_state, run_snapshot
from rowtide.queries.registry import query, table
from rowtide.session import shared_dir
from rowtide.sources.tables import pin_files, read_pinned
from rowtide.streaming.views import pinned_views, refresh_once

YEARS = range(1995, 2001)

CUSTOMER_VALUE = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


@query("""
    SELECT 'public.customer' AS "table", 'r' AS op, '{"c_custkey":' || c_custkey || '}' AS key,
      c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS consistent
    FROM customer""")
def snapshot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a message; the value is read back from its JSON."""
    customers = table(spark, sf_dir, "customer")
    messages = snapshot_table(customers, "public.customer", ["c_custkey"], position=2**32)
    value = F.from_json("value", CUSTOMER_VALUE)
    return messages.select("table", "op", "key", value.alias("v"), "consistent").select(
        "table", "op", "key", "v.*", "consistent"
    )


@query("""
    SELECT doc_id, 'public.documents' AS "table", '{"doc_id":' || doc_id || '}' AS key,
      md5(text) AS text_md5, lang, source, n_chars
    FROM documents""")
def snapshot_long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts survive the trip through JSON, escapes included."""
    docs = table(spark, sf_dir, "documents")
    messages = snapshot_table(docs, "public.documents", ["doc_id"])
    value = F.from_json("value", docs.schema)
    return messages.select("table", "key", value.alias("v")).select(
        "v.doc_id", "table", "key", F.md5("v.text").alias("text_md5"), "v.lang", "v.source", "v.n_chars"
    )


def order_children(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders by year of order date; 2001 has no child and goes to the default."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")

    def between_years(first: int, end: int) -> DataFrame:
        return orders.filter((day >= f"{first}-01-01") & (day < f"{end}-01-01"))

    children = {f"orders_{y}": between_years(y, y + 1) for y in YEARS}
    outside = (day < f"{YEARS[0]}-01-01") | (day >= f"{YEARS[-1] + 1}-01-01") | day.isNull()
    return {**children, "orders_default": orders.filter(outside)}


CHILD_SQL = """CASE WHEN year(o_orderdate) BETWEEN 1995 AND 2000
      THEN 'orders_' || year(o_orderdate) ELSE 'orders_default' END"""


@query(f"""
    SELECT 'public.orders' AS "table", {CHILD_SQL} AS unit,
      '{{"o_orderkey":' || o_orderkey || '}}' AS key, o_totalprice
    FROM orders""")
def snapshot_partitioned_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children are read apart and published under the root's name."""
    children = order_children(spark, sf_dir)
    messages = snapshot_partitioned(spark, children, "public.orders", ["o_orderkey"])
    price = F.get_json_object("value", "$.o_totalprice").cast("double")
    return messages.select("table", "unit", "key", price.alias("o_totalprice"))


@query(f"""
    SELECT {CHILD_SQL} AS unit, count(*) AS snapshot_rows FROM orders GROUP BY 1""")
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each physical child."""
    children = order_children(spark, sf_dir)
    return rows_by_partition(
        snapshot_partitioned(spark, children, "public.orders", ["o_orderkey"])
    )


@query(f"""
    SELECT o_orderkey, {CHILD_SQL} AS unit FROM orders""")
def partition_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open range routing with a default child."""
    ranges = [(f"orders_{y}", f"{y}-01-01", f"{y + 1}-01-01") for y in YEARS]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", route(F.col("o_orderdate"), ranges, "orders_default").alias("unit")
    )


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over three tables."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select("c_custkey", "n_name", "r_name")
    )


VIEW_SQL = """
    SELECT c_custkey, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VIEW_VALUE = """'{"c_custkey":' || c_custkey || ',"n_name":"' || n_name || '","r_name":"' || r_name || '"}'"""


@query(f"""
    SELECT 'public.customer_regions' AS "table", 'r' AS op, '{{}}' AS key, {VIEW_VALUE} AS value
    FROM ({VIEW_SQL})""")
def view_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view is read whole; its rows share the empty key."""
    view = customer_regions(spark, sf_dir)
    return snapshot_view(view, "public.customer_regions").select("table", "op", "key", "value")


@query(f"""
    SELECT cycle_id, "table", key, value FROM (
      SELECT 'public.customer_regions' AS "table", '{{}}' AS key, {VIEW_VALUE} AS value
      FROM ({VIEW_SQL})
      UNION ALL
      SELECT 'public.segments', '{{}}',
        '{{"c_mktsegment":"' || c_mktsegment || '","customers":' || count(*) || '}}'
      FROM customer GROUP BY c_mktsegment), (VALUES (1), (2)) AS cycles(cycle_id)""")
def view_refresh_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refresh cycles republish every view in full."""
    segments = (
        table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("customers"))
    )
    views = {
        "public.customer_regions": customer_regions(spark, sf_dir),
        "public.segments": segments,
    }
    cycles = refresh_views(views, 1).unionByName(refresh_views(views, 2))
    return cycles.select("cycle_id", "table", "key", "value")


@query("""
    SELECT l_returnflag, l_linestatus, '{}' AS key, count(*) AS snapshot_rows,
      CAST(sum(l_orderkey) AS BIGINT) AS orderkeys
    FROM lineitem GROUP BY ALL""")
def keyless_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyless object of many rows, read whole like a view."""
    fields = ("l_returnflag", "l_linestatus", "l_orderkey")
    return (
        snapshot_view(table(spark, sf_dir, "lineitem"), "public.lineitem")
        .select("key", F.json_tuple("value", *fields).alias(*fields))
        .groupBy("l_returnflag", "l_linestatus", "key")
        .agg(
            F.count("*").alias("snapshot_rows"),
            F.sum(F.col("l_orderkey").cast("bigint")).alias("orderkeys"),
        )
    )


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 777 ORDER BY o_orderkey LIMIT 1000""")
def keyset_page_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows a cursor."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keyset_page(orders, ["o_orderkey"], [777], 1000)


@query("""
    SELECT conv_id, turn, role FROM conversations WHERE (conv_id, turn) > (5, 1)
    ORDER BY conv_id, turn LIMIT 60""")
def keyset_page_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows a composite cursor."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return keyset_page(conv, ["conv_id", "turn"], [5, 1], 60)


@query("""
    SELECT '[' || conv_id || ',' || turn || ']' AS last_pk FROM conversations
    ORDER BY conv_id, turn LIMIT 1 OFFSET 39""")
def page_last_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cursor a page leaves behind."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return last_cursor(keyset_page(conv, ["conv_id", "turn"], None, 40), ["conv_id", "turn"])


@query("""
    SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations""")
def keyset_resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first page and the resumed rest are the whole table, once."""
    pk = ["conv_id", "turn"]
    conv = table(spark, sf_dir, "conversations")
    page = keyset_page(conv, pk, None, 40)
    saved = last_cursor(keyset_page(conv.select(*pk), pk, None, 40), pk).first()["last_pk"]
    rest = between(conv, pk, read_cursor(saved, conv, pk), None)
    return page.unionByName(rest).select(*pk, "role", F.md5("text").alias("text_md5"))


@query("""
    SELECT unit, CAST(fetch_size AS BIGINT) AS fetch_size, "rows", "rows" // fetch_size + 1 AS pages,
      "rows" % fetch_size AS last_page_rows
    FROM (SELECT 'orders_' || year(o_orderdate) AS unit, count(*) AS "rows" FROM orders GROUP BY 1),
      (VALUES (100), (1000), (20000)) AS sizes(fetch_size)""")
def pages_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each unit for three fetch sizes."""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("orders_"), F.year("o_orderdate")).alias("unit"))
        .agg(F.count("*").alias("rows"))
        .withColumn("fetch_size", F.explode(F.array(*[F.lit(n) for n in (100, 1000, 20000)])))
    )
    return page_plan(counts, F.col("fetch_size")).select(
        "unit", F.col("fetch_size").cast("bigint").alias("fetch_size"), "rows", "pages", "last_page_rows"
    )


@query("""
    SELECT count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS overlaps
    FROM orders""")
def range_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range pages hold all rows and do not overlap."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    pages = (
        range_pages(orders, ["o_orderkey"], 16)
        .groupBy(F.spark_partition_id().alias("page"))
        .agg(
            F.count("*").alias("rows"),
            F.sum("o_orderkey").alias("key_sum"),
            F.min("o_orderkey").alias("low"),
            F.max("o_orderkey").alias("high"),
        )
    )
    before = F.lag("high").over(Window.orderBy("page"))
    return pages.withColumn("overlap", F.coalesce(F.col("low") <= before, F.lit(False))).agg(
        F.sum("rows").alias("rows"),
        F.sum("key_sum").alias("key_sum"),
        F.count_if("overlap").alias("overlaps"),
    )


@query("""
    SELECT conv_id, turn, md5(text) AS text_md5, CAST(1 AS BIGINT) AS times_read FROM conversations""")
def range_unit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading every range unit by its cursors reads every row exactly once."""
    pk = ["conv_id", "turn"]
    conv = table(spark, sf_dir, "conversations")
    rows_per_unit = max(1, conv.count() // 8)
    parts = None
    for unit in range_units(conv, pk, rows_per_unit).toLocalIterator():
        start, end = (read_cursor(unit[c], conv, pk) for c in ("start", "end"))
        part = between(conv, pk, start, end)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(*pk, F.md5("text").alias("text_md5")).agg(
        F.count("*").alias("times_read")
    )


@query("""
    SELECT rn // 1000 AS page_no, '[' || o_orderkey || ']' AS last_pk
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn % 1000 = 0""")
def saved_page_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cursors that reading page after page would save."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return page_cursors(orders, ["o_orderkey"], 1000, slice_rows=20_000)


@query("""
    SELECT 'public.c' || c_custkey AS unit, c_custkey < 0 AS has_rows, TRUE AS done
    FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def empty_partitioned_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots without children: no rows, and finished at once.

    Customers stand for roots, their urgent finished orders for children.
    """
    roots = table(spark, sf_dir, "customer").select("c_custkey")
    children = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
        .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    )
    rows = row_messages(children, "public.children", ["o_orderkey"])
    empty = roots.join(children, "c_custkey", "left_anti").withColumn(
        "unit", F.concat(F.lit("public.c"), "c_custkey")
    )
    counted = empty.join(
        rows.select(F.get_json_object("value", "$.c_custkey").cast("bigint").alias("c_custkey"))
        .groupBy("c_custkey")
        .agg(F.count("*").alias("n")),
        "c_custkey",
        "left",
    )
    return counted.select(
        "unit", (F.coalesce("n", F.lit(0)) > 0).alias("has_rows"), F.lit(True).alias("done")
    )


@query("""
    SELECT 'public.nation' AS unit, TRUE AS done, count(*) AS "rows" FROM nation
    UNION ALL SELECT 'public.empty', TRUE, 0 FROM (SELECT count(*) FROM nation)""")
def snapshot_empty_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A root without children is finished at once, without rows; a table beside it is read."""
    folder = f"{shared_dir(spark)}/rowtide-{uuid4().hex}"
    objects = [
        SourceObject("public.empty", "part_root", ("n_nationkey",)),
        SourceObject("public.nation", "table", ("n_nationkey",)),
    ]
    run_snapshot(
        spark, objects, lambda _: table(spark, sf_dir, "nation"), f"{folder}/out", f"{folder}/state", point=1
    )
    messages = spark.read.parquet(f"{folder}/out").groupBy(F.col("table").alias("unit")).agg(
        F.count("*").alias("rows")
    )
    state = read_state(spark, f"{folder}/state").select("unit", "done")
    return state.join(messages, "unit", "left").select(
        "unit", "done", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
    )


@query("""
    SELECT conv_id, turn FROM conversations""")
def keyset_resume_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binary key: a first page and the resumed rest are the whole table, once."""
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.unhex(F.md5(F.concat_ws(".", "conv_id", "turn"))).alias("id")
    )
    page = keyset_page(conv, ["id"], None, 40)
    saved = last_cursor(keyset_page(conv, ["id"], None, 40), ["id"]).first()["last_pk"]
    rest = between(conv, ["id"], read_cursor(saved, conv, ["id"]), None)
    return page.unionByName(rest).select("conv_id", "turn")


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders""")
def pinned_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pinned table keeps its partition columns and does not see later rows."""
    folder = f"{shared_dir(spark)}/rowtide-{uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = f"{folder}/or ders"
    orders.write.partitionBy("o_orderpriority").parquet(path)
    pin_files(spark, path, f"{folder}/manifest")
    orders.write.mode("append").partitionBy("o_orderpriority").parquet(path)
    return read_pinned(spark, f"{folder}/manifest").select("o_orderkey", "o_orderpriority")


@query("""
    WITH both_cycles AS (SELECT 1 AS cycle, * FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT 2, * FROM orders)
    SELECT cycle, 'public.per_status' AS "table",
      '{"n":' || count(*) || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value
    FROM both_cycles GROUP BY cycle, o_orderstatus
    UNION ALL
    SELECT cycle, 'public.per_segment', '{"c_mktsegment":"' || c_mktsegment || '","n":' || count(*) || '}'
    FROM both_cycles JOIN customer ON o_custkey = c_custkey GROUP BY cycle, c_mktsegment""")
def refresh_pinned_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two views of a cycle agree although rows come in between their reads."""
    folder = f"{shared_dir(spark)}/rowtide-{uuid4().hex}"
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    tables = {"orders": f"{folder}/orders", "customer": f"{folder}/customer"}
    late = orders.filter("o_orderkey % 2 <> 0")
    orders.filter("o_orderkey % 2 = 0").write.parquet(tables["orders"])
    customers.write.parquet(tables["customer"])

    def per_status(read):
        found = read("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        if cycle == 1:
            late.write.mode("append").parquet(tables["orders"])
        return found

    def per_segment(read):
        placed = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return placed.groupBy("c_mktsegment").agg(F.count("*").alias("n"))

    views = {"public.per_status": per_status, "public.per_segment": per_segment}
    for cycle in (1, 2):
        refresh_once(pinned_views(spark, tables, views, f"{folder}/points", cycle), f"{folder}/out", cycle)
    return spark.read.parquet(f"{folder}/out").select("cycle", "table", "value")
