"""Change decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.json_text import json_scalar
from rowtide.functions.pgtypes import decode_text, json_text, spark_type
from rowtide.operators.decode import (
    commit_positions,
    decode_changes,
    distinct_changes,
    truncate_audit,
)
from rowtide.operators.messages import split_quarantine
from rowtide.operators.relations import relation_asof, relation_versions
from rowtide.queries.feed import (
    FEED_SQL,
    USERS,
    change_log,
    feed,
    first_change,
    kind_of,
    log_rows,
    marked,
    relation,
    session_relations,
    text,
    user_changes,
)
from rowtide.queries.registry import query, table
from rowtide.schemas import TUPLE
from rowtide.sources.change_log import published_only

USER_KEY_SQL = """'{"user_id":' || user_id || '}'"""


@query(f"""
    WITH {FEED_SQL}
    SELECT 'public.users' AS "table", op, {USER_KEY_SQL} AS key, commit_pos, ord,
      CASE WHEN op <> 'd' THEN user_id END AS user_id,
      CASE WHEN op <> 'd' THEN value END AS value,
      CASE WHEN op <> 'd' AND event_type <> 'view' THEN props END AS props,
      printf('%X/%X', commit_pos >> 32, commit_pos & 4294967295) AS lsn
    FROM feed""")
def change_feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates and tombstones, the value read back from its JSON."""
    messages = decode_changes(change_log(spark, sf_dir))
    value = F.from_json("value", "user_id bigint, value double, props string")
    return messages.select("table", "op", "key", "commit_pos", "ord", value.alias("v"), "lsn").select(
        "table", "op", "key", "commit_pos", "ord", "v.*", "lsn"
    )


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, CASE WHEN op = 'd' THEN NULL
      WHEN event_type = 'view' THEN '{{"user_id":' || user_id || '}}'
      WHEN event_type = 'signup' THEN '{{"props":null,"user_id":' || user_id || '}}'
      ELSE '{{"props":"' || replace(props, '"', '\\"') || '","user_id":' || user_id || '}}' END AS value
    FROM feed""")
def toast_omission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchanged values are absent from the JSON, NULLs are present as null."""
    events = feed(spark, sf_dir)
    props = (
        F.when(F.col("event_type") == "view", marked("u"))
        .when(F.col("event_type") == "signup", marked("n"))
        .otherwise(text(F.col("props")))
    )
    dead = F.col("op") == "d"
    pair = F.array(text(F.col("user_id")), props).cast(TUPLE)
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(dead, pair),
        new_tuple=F.when(~dead, pair),
    )
    known = log_rows(
        first_change(events),
        "R",
        relation_id=F.lit(USERS),
        relation=relation("public", "users", [("user_id", 20, 1), ("props", 25, 0)]),
    )
    messages = decode_changes(changes.unionByName(known))
    # The position of the row: from the place in the log back to the event.
    return messages.select(row_lsn().alias("lsn"), "value")


def row_lsn():
    """Row position of a change, from its commit position and `ord`."""
    block_end = F.expr("(commit_pos - 4294967300) div 16")
    member = F.expr("((commit_pos - 4294967300) % 16) div 4")
    event = block_end - 14 + F.col("ord") * 3 + member
    return event * 16 + 2**32


@query("""
    SELECT event_id, CAST(user_id AS BIGINT) AS as_int8, value AS as_float8,
      CASE WHEN event_type = 'click' THEN 'oops' END AS raw_text,
      event_type IN ('view', 'signup') AS as_bool,
      CASE WHEN event_type = 'click' THEN '"oops"' ELSE CAST(user_id AS VARCHAR) END AS json_int8,
      '"' || replace(props, '"', '\\"') || '"' AS json_unknown
    FROM events""")
def decode_typed_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text to typed values; what does not parse stays raw text."""
    events = table(spark, sf_dir, "events")
    raw_int = F.when(F.col("event_type") == "click", "oops").otherwise(F.col("user_id").cast("string"))
    raw_bool = F.when(F.col("event_type").isin("view", "signup"), "t").otherwise("f")
    raws = events.select(
        "event_id",
        raw_int.alias("i"),
        F.col("value").cast("string").alias("f"),
        raw_bool.alias("b"),
        "props",
        "user_id",
    )
    as_int = decode_text(F.col("i"), spark_type(20))
    return raws.select(
        "event_id",
        F.coalesce(as_int, F.col("user_id")).alias("as_int8"),
        decode_text(F.col("f"), spark_type(701)).alias("as_float8"),
        F.when(as_int.isNull(), F.col("i")).alias("raw_text"),
        decode_text(F.col("b"), spark_type(16)).alias("as_bool"),
        json_text(F.col("i"), F.lit(20)).alias("json_int8"),
        json_text(F.col("props"), F.lit(999999)).alias("json_unknown"),
    )


@query("""
    SELECT o_orderkey,
      '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z"' AS json_timestamp,
      '"' || strftime(o_orderdate, '%Y-%m-%dT00:00:00') || 'Z"' AS json_date,
      '[' || o_orderkey || ',null,' || o_custkey || ']' AS json_array,
      o_custkey || '.5' AS json_numeric,
      TRUE AS same_bytes
    FROM orders""")
def decode_typed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of timestamps, dates, arrays and numerics in log text.

    A typed snapshot column gives the same bytes as the log's text.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").alias("at"),
        F.concat(F.col("o_orderdate").cast("string"), F.lit("+00")).alias("ts"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.concat(F.lit("{"), "o_orderkey", F.lit(",NULL,"), "o_custkey", F.lit("}")).alias("arr"),
        F.concat("o_custkey", F.lit(".500")).alias("num"),
    )
    ts_json = json_text(F.col("ts"), F.lit(1184))
    num_json = json_text(F.col("num"), F.lit(1700))
    typed = orders.select(
        "o_orderkey",
        ts_json.alias("json_timestamp"),
        json_text(F.col("day"), F.lit(1082)).alias("json_date"),
        json_text(F.col("arr"), F.lit(1016)).alias("json_array"),
        num_json.alias("json_numeric"),
        (
            (json_scalar(F.col("at"), orders.schema["at"].dataType) == ts_json)
            & (json_scalar(F.col("num").cast("decimal(20,6)"), spark_type(1700, 20, 6)) == num_json)
        ).alias("same_bytes"),
    )
    return typed


# Five relations, one per event type. An event of high value is preceded by a
# relation message, whose number of columns changes with time.
VERSION_CTE = """versions AS (
      SELECT event_type, commit_pos * 8 + ord AS at, 1 + (event_id // 50) % 4 AS n_columns
      FROM feed WHERE value > 60)"""


def relation_ids(event_type):
    kinds = ["click", "error", "purchase", "signup", "view"]
    ids = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(100 + i))])
    return F.element_at(ids, event_type)


def versioned_log(events: DataFrame) -> DataFrame:
    changes = user_changes(events, relation_ids(F.col("event_type")))
    width = (F.expr("(event_id div 50) % 4") + 1).cast("int")
    columns = F.transform(
        F.sequence(F.lit(1), width),
        lambda i: F.struct(
            F.concat(F.lit("c"), i.cast("string")).alias("name"),
            F.lit(25).cast("bigint").alias("type_oid"),
            F.when(i == 1, 1).otherwise(0).alias("flags"),
        ),
    )
    announced = log_rows(
        events.filter("value > 60"),
        "R",
        relation_id=relation_ids(F.col("event_type")),
        relation=F.struct(
            F.lit("public").alias("namespace"),
            F.col("event_type").alias("name"),
            columns.alias("columns"),
        ),
    )
    return changes.unionByName(announced)


@query(f"""
    WITH {FEED_SQL}, {VERSION_CTE}
    SELECT f.lsn, CASE WHEN v.at IS NOT NULL THEN 'public.' || f.event_type END AS "table",
      v.n_columns
    FROM (SELECT *, commit_pos * 8 + ord AS at FROM feed) f
    ASOF LEFT JOIN versions v ON f.event_type = v.event_type AND f.at >= v.at""")
def relation_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change with the relation version in force at its position."""
    log = versioned_log(feed(spark, sf_dir))
    changes = log.filter("kind <> 'R'").select("relation_id", "commit_pos", "ord", "wal_pos")
    versions = relation_versions(log).select(
        "relation_id",
        "valid_from",
        F.concat_ws(".", "relation.namespace", "relation.name").alias("table"),
        F.size("relation.columns").cast("bigint").alias("n_columns"),
    )
    return relation_asof(changes, versions).select(
        F.col("wal_pos").alias("lsn"), "table", "n_columns"
    )


@query(f"""
    WITH {FEED_SQL}, {VERSION_CTE}
    SELECT f.lsn, least(v.n_columns, CASE WHEN f.event_type = 'view' THEN 2 ELSE 3 END) AS fields,
      f.op
    FROM (SELECT *, commit_pos * 8 + ord AS at FROM feed) f
    ASOF JOIN versions v ON f.event_type = v.event_type AND f.at >= v.at WHERE op <> 'd'""")
def surplus_columns_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuple columns beyond the relation's are dropped, missing ones absent."""
    good, _ = split_quarantine(decode_changes(versioned_log(feed(spark, sf_dir))))
    fields = F.size(F.json_object_keys("value")).cast("bigint")
    return good.filter("op <> 'd'").select(row_lsn().alias("lsn"), fields.alias("fields"), "op")


@query(f"""
    WITH {FEED_SQL}, {VERSION_CTE}
    SELECT f.lsn, f.op, 'unknown_relation' AS error
    FROM (SELECT *, commit_pos * 8 + ord AS at FROM feed) f
    WHERE NOT EXISTS (SELECT 1 FROM versions v WHERE v.event_type = f.event_type AND v.at <= f.at)""")
def unknown_relation_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that come before any message about their relation."""
    _, bad = split_quarantine(decode_changes(versioned_log(feed(spark, sf_dir))))
    return bad.filter("error = 'unknown_relation'").select(row_lsn().alias("lsn"), "op", "error")


def damaged_log(events: DataFrame) -> DataFrame:
    """The users log: some deletes lack the old tuple, purchases are binary."""
    binary = F.struct(F.lit("b").alias("status"), F.col("value").cast("string").alias("data"))
    value = F.when(F.col("event_type") == "purchase", binary).otherwise(text(F.col("value")))
    new = F.array(text(F.col("user_id")), value, text(F.col("props"))).cast(TUPLE)
    old = F.array(text(F.col("user_id")), marked("n"), marked("n")).cast(TUPLE)
    dead = F.col("op") == "d"
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(dead & (F.col("value") >= 10), old),
        new_tuple=F.when(~dead, new),
    )
    return changes.unionByName(session_relations(events))


@query(f"""
    WITH {FEED_SQL}
    SELECT user_id, count(*) AS dropped FROM feed WHERE op = 'd' AND value < 10 GROUP BY user_id""")
def delete_without_old_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes whose key is not known are set aside."""
    events = feed(spark, sf_dir)
    _, bad = split_quarantine(decode_changes(damaged_log(events)))
    dropped = bad.filter("error = 'delete_without_old_tuple'").select(row_lsn().alias("lsn"))
    return (
        dropped.join(events.select("lsn", "user_id"), "lsn")
        .groupBy("user_id")
        .agg(F.count("*").alias("dropped"))
    )


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op, 'binary_tuple' AS error FROM feed WHERE event_type = 'purchase'""")
def binary_status_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples with binary columns are set aside."""
    _, bad = split_quarantine(decode_changes(damaged_log(feed(spark, sf_dir))))
    return bad.filter("error = 'binary_tuple'").select(row_lsn().alias("lsn"), "op", "error")


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op, 'unencodable_float' AS error FROM feed WHERE event_type = 'click'""")
def float_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinity have no JSON form."""
    events = feed(spark, sf_dir)
    odd = F.when(F.col("user_id") % 2 == 0, "NaN").otherwise("-Infinity")
    events = events.withColumn(
        "value", F.when(F.col("event_type") == "click", odd).otherwise(F.col("value").cast("string"))
    )
    log = user_changes(events).unionByName(session_relations(events))
    _, bad = split_quarantine(decode_changes(log))
    return bad.select(row_lsn().alias("lsn"), "op", "error")


@query(f"""
    WITH {FEED_SQL}
    SELECT t."table", commit_pos, ord FROM feed,
      (VALUES ('public.users'), ('public.orders')) AS t("table") WHERE event_type = 'error'""")
def truncates_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per truncated known table; ids never announced are skipped."""
    events = feed(spark, sf_dir)
    truncates = log_rows(
        events.filter("event_type = 'error'"),
        "T",
        relation_ids=F.array(F.lit(USERS), F.lit(USERS + 1), F.lit(USERS + 2)),
    )
    orders = session_relations(events).withColumns(
        {
            "relation_id": F.lit(USERS + 1).cast("bigint"),
            "relation": F.col("relation").withField("name", F.lit("orders")),
        }
    )
    log = truncates.unionByName(session_relations(events)).unionByName(orders)
    return truncate_audit(log)


@query("""
    SELECT 'public.orders' AS "table", '{"o_orderkey":' || o_orderkey || '}' AS key,
      year(o_orderdate) AS year FROM orders""")
def leaf_to_root_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes logged under a leaf's name are published under the root's."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    changes = log_rows(
        orders,
        "I",
        commit_pos=F.col("o_orderkey") + 100,
        ord=F.lit(0),
        relation_id=F.col("year"),
        new_tuple=F.array(text(F.col("o_orderkey")), text(F.col("year"))).cast(TUPLE),
    )
    leaves = orders.select("year").distinct()
    name = F.concat(F.lit("orders_"), "year")
    known = log_rows(
        leaves,
        "R",
        commit_pos=F.lit(0),
        ord=F.lit(0),
        relation_id=F.col("year"),
        relation=relation("public", "x", [("o_orderkey", 20, 1), ("year", 23, 0)]).withField(
            "name", name
        ),
    )
    roots = leaves.select(
        F.concat(F.lit("public."), name).alias("table"), F.lit("public.orders").alias("root")
    )
    messages = decode_changes(changes.unionByName(known), roots=roots)
    year = F.get_json_object("value", "$.year").cast("bigint")
    return messages.select("table", "key", year.alias("year"))


@query(f"""
    WITH {FEED_SQL}
    SELECT xid, max(commit_pos) AS commit_pos FROM feed GROUP BY xid""")
def commit_per_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit position of every transaction."""
    return commit_positions(change_log(spark, sf_dir))


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op FROM feed""")
def replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with a resent second half holds every change once."""
    events = feed(spark, sf_dir)
    log = user_changes(events)
    middle = events.agg(F.expr("(min(commit_pos) + max(commit_pos)) div 2").alias("p")).first()["p"]
    resent = log.filter(F.col("commit_pos") >= middle)
    once = distinct_changes(log.unionByName(resent))
    op = F.when(F.col("kind") == "I", "c").when(F.col("kind") == "D", "d").otherwise("u")
    return once.select(F.col("wal_pos").alias("lsn"), op.alias("op"))


@query(f"""
    WITH {FEED_SQL}
    SELECT key, op, commit_pos, ord FROM (
      SELECT '{{"user_id":' || user_id + 1 || '}}' AS key, op, commit_pos, ord FROM feed WHERE op <> 'd'
      UNION ALL
      SELECT '{{"user_id":' || user_id || '}}', 'd', commit_pos, ord FROM feed
      WHERE op = 'd' OR event_type = 'purchase')""")
def pk_change_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that moves a row to another key also ends the old key."""
    events = feed(spark, sf_dir)
    moved = F.col("event_type") == "purchase"
    old = F.array(text(F.col("user_id")), marked("n"), marked("n")).cast(TUPLE)
    new = F.array(text(F.col("user_id") + 1), text(F.col("value")), text(F.col("props"))).cast(TUPLE)
    dead = F.col("op") == "d"
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(dead | moved, old),
        new_tuple=F.when(~dead, new),
    )
    log = changes.unionByName(session_relations(events))
    return decode_changes(log, old_key_tombstones=True).select("key", "op", "commit_pos", "ord")


@query(f"""
    WITH {FEED_SQL}
    SELECT '{{"props":"' || replace(props, '"', '\\"') || '","user_id":' || user_id || ',"value":null}}' AS key,
      lsn FROM feed WHERE op <> 'd'""")
def replica_identity_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a full replica identity every column is in the key.

    A column the tuple leaves out is null there.
    """
    events = feed(spark, sf_dir).filter("op <> 'd'")
    sent = F.array(text(F.col("user_id")), marked("u"), text(F.col("props"))).cast(TUPLE)
    changes = log_rows(events, kind_of(F.col("op")), relation_id=F.lit(USERS), new_tuple=sent)
    columns = [("user_id", 20, 1), ("value", 701, 1), ("props", 25, 1)]
    known = log_rows(
        first_change(events),
        "R",
        relation_id=F.lit(USERS),
        relation=relation("public", "users", columns),
    )
    messages = decode_changes(changes.unionByName(known))
    return messages.select("key", row_lsn().alias("lsn"))


@query(f"""
    WITH {FEED_SQL}
    SELECT CASE WHEN event_type IN ('view') THEN '{{"props":null}}'
      WHEN op = 'd' THEN '{{"props":null}}'
      ELSE '{{"props":"' || replace(props, '"', '\\"') || '"}}' END AS key, lsn,
      CASE WHEN event_type = 'view' THEN 'key_not_sent' END AS error
    FROM feed""")
def catalog_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's primary key wins over the replica identity.

    Where the log leaves the key's column out, the message is an error.
    """
    events = feed(spark, sf_dir)
    pk = first_change(events).select(
        F.lit("public.users").alias("table"), F.array(F.lit("props")).alias("pk_columns")
    )
    messages = decode_changes(change_log(spark, sf_dir), pk=pk)
    return messages.select("key", row_lsn().alias("lsn"), "error")


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op FROM feed WHERE event_type IN ('click', 'signup')""")
def published_relations_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of relations outside the publication are left out."""
    log = versioned_log(feed(spark, sf_dir))
    published = (
        table(spark, sf_dir, "events")
        .filter("event_type IN ('click', 'signup')")
        .select(relation_ids(F.col("event_type")).cast("bigint").alias("relation_id"))
        .distinct()
    )
    kept = published_only(log, published).filter("kind <> 'R'")
    op = F.when(F.col("kind") == "I", "c").when(F.col("kind") == "D", "d").otherwise("u")
    return kept.select(F.col("wal_pos").alias("lsn"), op.alias("op"))


def full_identity(events: DataFrame, value) -> DataFrame:
    """The users log under a full replica identity, with `value` as text."""
    whole = F.array(text(F.col("user_id")), text(value), text(F.col("props"))).cast(TUPLE)
    dead = F.col("op") == "d"
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(F.col("op") != "c", whole),
        new_tuple=F.when(~dead, whole),
    )
    known = log_rows(
        first_change(events),
        "R",
        relation_id=F.lit(USERS),
        relation=relation("public", "users", [("user_id", 20, 1), ("value", 701, 1), ("props", 25, 1)]),
    )
    return changes.unionByName(known)


def users_pk(events: DataFrame) -> DataFrame:
    return first_change(events).select(
        F.lit("public.users").alias("table"), F.array(F.lit("user_id")).alias("pk_columns")
    )


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op, {USER_KEY_SQL} AS key,
      CASE WHEN op <> 'd' AND event_type = 'click' THEN 'unencodable_float' END AS error FROM feed""")
def delete_full_identity_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delete needs its key alone: a NaN elsewhere in the old row does not matter."""
    events = feed(spark, sf_dir)
    odd = F.when(F.col("event_type").isin("click", "error"), "NaN").otherwise(F.col("value").cast("string"))
    messages = decode_changes(full_identity(events, odd), pk=users_pk(events))
    return messages.select(row_lsn().alias("lsn"), "op", "key", "error")


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, op, CASE WHEN event_type = 'purchase' THEN '{{"user_id":null}}' ELSE {USER_KEY_SQL} END AS key,
      CASE WHEN event_type = 'purchase' THEN 'key_not_sent' END AS error FROM feed WHERE op <> 'd'""")
def key_not_sent_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key column that was not sent comes from the old tuple, else the change is set aside."""
    events = feed(spark, sf_dir).filter("op <> 'd'")
    own, lost = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    new = F.array(F.when(own, text(F.col("user_id"))).otherwise(marked("u")), text(F.col("value")), text(F.col("props")))
    old = F.array(text(F.col("user_id")), marked("n"), marked("n")).cast(TUPLE)
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(~own & ~lost, old),
        new_tuple=new.cast(TUPLE),
    )
    messages = decode_changes(changes.unionByName(session_relations(events)))
    return messages.select(row_lsn().alias("lsn"), "op", "key", "error")


# Sixty column lists: a relation for each, told apart by a column's name.
SHAPES = 60


@query(f"""
    WITH {FEED_SQL}
    SELECT lsn, 'public.t' || (event_id % {SHAPES}) AS "table", op, {USER_KEY_SQL} AS key,
      CASE WHEN op <> 'd' THEN props END AS props FROM feed""")
def decode_many_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More column lists than are written out: one expression gives the same messages."""
    events = feed(spark, sf_dir)
    shape = F.col("event_id") % SHAPES
    whole = F.array(text(F.col("user_id")), text(F.col("props"))).cast(TUPLE)
    dead = F.col("op") == "d"
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=shape,
        old_tuple=F.when(dead, whole),
        new_tuple=F.when(~dead, whole),
    )
    first = events.groupBy(shape.alias("shape")).agg(
        F.min("xid").alias("xid"), F.min(F.struct("commit_pos", "ord")).alias("first")
    )
    label = F.concat(F.lit("t"), F.col("shape"))
    columns = F.array(
        F.struct(F.lit("user_id").alias("name"), F.lit(20).cast("bigint").alias("type_oid"), F.lit(1).alias("flags")),
        F.struct(F.concat(F.lit("props_"), label).alias("name"), F.lit(25).cast("bigint").alias("type_oid"), F.lit(0).alias("flags")),
    )
    known = log_rows(
        first.select("shape", "xid", "first.*"),
        "R",
        relation_id=F.col("shape"),
        relation=F.struct(F.lit("public").alias("namespace"), label.alias("name"), columns.alias("columns")),
    )
    messages = decode_changes(changes.unionByName(known))
    pair = F.from_json("value", "map<string,string>")
    name = F.concat(F.lit("props_"), F.split_part("table", F.lit("."), F.lit(2)))
    return messages.select(
        row_lsn().alias("lsn"), "table", "op", "key", F.try_element_at(pair, name).alias("props")
    )


# A relation for each user; one holds a new version at every event of it.
@query(f"""
    WITH {FEED_SQL}, placed AS (
      SELECT *, commit_pos * 8 + ord AS pos,
        CASE WHEN event_type = 'view' THEN 0 ELSE user_id + 1 END AS rel FROM feed),
    versions AS (SELECT rel, pos, event_id AS "version" FROM placed WHERE rel = 0 OR event_id % 3 = 0)
    SELECT p.lsn, v."version" FROM placed p ASOF LEFT JOIN versions v ON p.rel = v.rel AND p.pos >= v.pos""")
def relation_as_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very many relations, and one with very many versions."""
    events = feed(spark, sf_dir)
    hot = F.col("event_type") == "view"
    placed = events.withColumn("relation_id", F.when(hot, 0).otherwise(F.col("user_id") + 1).cast("bigint"))
    versions = placed.filter((F.col("relation_id") == 0) | (F.col("event_id") % 3 == 0)).select(
        "relation_id",
        F.struct("commit_pos", F.col("ord").cast("bigint").alias("ord")).alias("valid_from"),
        F.col("event_id").alias("version"),
    )
    changes = placed.select("relation_id", "commit_pos", "ord", "lsn")
    return relation_asof(changes, versions).select("lsn", "version")


@query("""
    SELECT 'd' || doc_id AS id, to_json([text, NULL, doc_id::VARCHAR])::VARCHAR AS json, true AS same_bytes FROM documents
    UNION ALL SELECT 'c' || conv_id || '.' || turn, to_json([text, NULL, conv_id::VARCHAR])::VARCHAR, true FROM conversations""")
def decode_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of quoted and escaped text: the same JSON as from a typed column."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), "text", F.col("doc_id").cast("string").alias("n")
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("."), "turn").alias("id"), "text", F.col("conv_id").cast("string").alias("n")
    )
    rows = docs.unionByName(turns)
    escaped = F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    raw = F.concat(F.lit('{"'), escaped, F.lit('",NULL,'), "n", F.lit("}"))
    typed = F.array("text", F.lit(None).cast("string"), "n")
    made = rows.select("id", json_text(raw, F.lit(1009)).alias("json"), typed.alias("typed"))
    same = json_scalar(F.col("typed"), made.schema["typed"].dataType) == F.col("json")
    return made.select("id", "json", same.alias("same_bytes"))


@query("""
    SELECT o_orderkey,
      '{"Lower":' || o_orderkey || ',"Upper":' || o_orderkey + o_custkey || ',"LowerType":105,"UpperType":101,"Valid":true}' AS keys,
      '{"Lower":"' || strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') || '","Upper":null,"LowerType":105,"UpperType":85,"Valid":true}' AS days,
      '[{"Lower":null,"Upper":0,"LowerType":85,"UpperType":105,"Valid":true},{"Lower":' || o_custkey
        || ',"Upper":' || o_custkey + 1 || ',"LowerType":101,"UpperType":101,"Valid":true}]' AS customers,
      '{"Microseconds":' || -(o_custkey % 100 * 3600000000 + 1500000) || ',"Days":' || o_orderkey % 30
        || ',"Months":' || 12 + o_custkey % 12 || ',"Valid":true}' AS term
    FROM orders""")
def decode_range_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges, multiranges and intervals in text form as JSON."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    customer = F.col("o_custkey")
    hours = F.lpad((customer % 100).cast("string"), 2, "0")
    raw = {
        "keys": (3926, F.concat(F.lit("["), "o_orderkey", F.lit(","), F.col("o_orderkey") + customer, F.lit(")"))),
        "days": (3912, F.concat(F.lit("["), day, F.lit(",)"))),
        "customers": (4536, F.concat(F.lit("{(,0],("), customer, F.lit(","), customer + 1, F.lit(")}"))),
        "term": (
            1186,
            F.concat(
                F.lit("1 year "), customer % 12, F.lit(" mons "), F.col("o_orderkey") % 30, F.lit(" days -"), hours, F.lit(":00:01.5")
            ),
        ),
    }
    return orders.select("o_orderkey", *[json_text(text, oid).alias(name) for name, (oid, text) in raw.items()])
