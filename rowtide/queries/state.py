"""Tables rebuilt from the messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.operators.decode import decode_changes, truncate_audit, typed_rows
from rowtide.operators.lineage import fill_moved
from rowtide.operators.messages import MESSAGE_COLUMNS, row_messages
from rowtide.operators.state import current_table, fill_omitted, table_as_of
from rowtide.queries.feed import (
    FEED_SQL,
    USER_COLUMNS,
    USERS,
    change_log,
    feed,
    kind_of,
    log_rows,
    marked,
    session_relations,
    text,
)
from rowtide.queries.registry import query
from rowtide.schemas import TUPLE

NEWEST = "row_number() OVER (PARTITION BY user_id ORDER BY commit_pos DESC, ord DESC) = 1"


@query(f"""
    WITH {FEED_SQL}
    SELECT '{{"user_id":' || user_id || '}}' AS key, op, commit_pos, ord, value,
      CASE WHEN event_type <> 'view' THEN props END AS props
    FROM feed QUALIFY {NEWEST} AND op <> 'd'""")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows: the newest message of each key unless it is a tombstone."""
    live = current_table(decode_changes(change_log(spark, sf_dir)).drop("ts", "error"))
    value = F.from_json("value", "value double, props string")
    return live.select("key", "op", "commit_pos", "ord", value.alias("v")).select(
        "key", "op", "commit_pos", "ord", "v.*"
    )


@query(f"""
    WITH {FEED_SQL}, point AS (SELECT (min(commit_pos) + max(commit_pos)) // 2 AS p FROM feed)
    SELECT '{{"user_id":' || user_id || '}}' AS key, op, commit_pos, ord
    FROM feed, point WHERE commit_pos <= p QUALIFY {NEWEST} AND op <> 'd'""")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows at an earlier position."""
    point = (
        feed(spark, sf_dir)
        .agg(F.expr("(min(commit_pos) + max(commit_pos)) div 2").alias("p"))
        .first()["p"]
    )
    messages = decode_changes(change_log(spark, sf_dir)).select("table", "key", "op", "commit_pos", "ord")
    return table_as_of(messages, point).drop("table")


@query(f"""
    WITH {FEED_SQL},
    placed AS (SELECT *, commit_pos * 8 + ord AS pos FROM feed),
    died AS (SELECT user_id, max(pos) AS last_death FROM placed WHERE op = 'd' GROUP BY 1),
    alive AS (
      SELECT placed.* FROM placed LEFT JOIN died USING (user_id)
      WHERE last_death IS NULL OR pos > last_death)
    SELECT user_id, max(commit_pos) AS commit_pos, arg_max(op, pos) AS op,
      arg_max(value, pos) AS value,
      arg_max(props, CASE WHEN event_type <> 'view' THEN pos END) AS props
    FROM alive GROUP BY user_id""")
def state_omitted_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows; values the log left out come from the row's own past."""
    rows = typed_rows(change_log(spark, sf_dir), USER_COLUMNS, USERS)
    return fill_omitted(rows, ["user_id"], ["value", "props"]).select(
        "user_id", "commit_pos", "op", "value", "props"
    )


@query(f"""
    WITH {FEED_SQL},
    cut AS (SELECT max(commit_pos * 8 + ord) AS at FROM feed WHERE event_type = 'signup' AND value > 70)
    SELECT '{{"user_id":' || user_id || '}}' AS key, op, commit_pos, ord FROM feed, cut
    WHERE commit_pos * 8 + ord > cut.at QUALIFY {NEWEST} AND op <> 'd'""")
def state_after_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows when truncates are applied."""
    events = feed(spark, sf_dir)
    truncates = log_rows(
        events.filter("event_type = 'signup' AND value > 70"),
        "T",
        relation_ids=F.array(F.lit(USERS)),
    )
    audit = truncate_audit(truncates.unionByName(session_relations(events)))
    messages = decode_changes(change_log(spark, sf_dir)).select("table", "key", "op", "commit_pos", "ord")
    return current_table(messages, truncates=audit).drop("table")


@query(f"""
    WITH {FEED_SQL}, point AS (SELECT (min(commit_pos) + max(commit_pos)) // 2 AS p FROM feed),
    changed AS (SELECT user_id, op FROM feed, point WHERE commit_pos <= p QUALIFY {NEWEST})
    SELECT '{{"user_id":' || u.user_id || '}}' AS key, coalesce(c.op, 'r') AS op
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN changed c USING (user_id)
    WHERE c.op IS NULL OR c.op <> 'd'""")
def state_as_of_unpinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a snapshot without a position come before every change."""
    events = feed(spark, sf_dir)
    point = events.agg(F.expr("(min(commit_pos) + max(commit_pos)) div 2").alias("p")).first()["p"]
    changes = decode_changes(change_log(spark, sf_dir)).select(*MESSAGE_COLUMNS)
    rows = row_messages(events.select("user_id").distinct(), "public.users", ["user_id"])
    both = changes.unionByName(rows.select(*MESSAGE_COLUMNS))
    return table_as_of(both, point).select("key", "op")


@query(f"""
    WITH {FEED_SQL}, messages AS (
      SELECT user_id + 1 AS key, op, commit_pos, ord, 1 AS turn, value FROM feed WHERE op <> 'd'
      UNION ALL SELECT user_id, 'd', commit_pos, ord, 0, NULL FROM feed WHERE op = 'd' OR event_type = 'purchase')
    SELECT '{{"user_id":' || key || '}}' AS key, op, value FROM messages
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY commit_pos DESC, ord DESC) = 1 AND op <> 'd'""")
def moved_key_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row that moved to another key is live under the new one alone."""
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
    live = current_table(decode_changes(changes.unionByName(session_relations(events))))
    value = F.get_json_object("value", "$.value").cast("double")
    return live.select("key", "op", value.alias("value"))


@query(f"""
    WITH RECURSIVE {FEED_SQL},
    events_of_key AS (
      SELECT user_id + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS key,
        commit_pos * 8 + ord AS pos, commit_pos, op, value, CASE WHEN event_type IN ('click', 'signup') THEN props END AS props,
        op = 'd' OR event_type = 'purchase' AS cut, CAST(NULL AS BIGINT) AS went FROM feed
      UNION ALL SELECT user_id, commit_pos * 8 + ord, commit_pos, 'd', NULL, NULL, TRUE, user_id + 1
      FROM feed WHERE event_type = 'purchase'),
    placed AS (
      SELECT *, coalesce(max(CASE WHEN cut THEN pos END) OVER (
        PARTITION BY key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before
      FROM events_of_key),
    lives AS (
      SELECT key, CASE WHEN cut THEN pos ELSE before END AS began, max(commit_pos) AS commit_pos,
        arg_max(op, pos) AS op, arg_max(value, pos) AS value,
        arg_max(props, CASE WHEN props IS NOT NULL THEN pos END) AS props
      FROM placed GROUP BY 1, 2),
    parents AS (SELECT went AS key, pos AS began, key AS up_key, before AS up FROM placed WHERE went IS NOT NULL),
    live AS (SELECT * FROM lives QUALIFY row_number() OVER (PARTITION BY key ORDER BY began DESC) = 1 AND op <> 'd'),
    walk AS (
      SELECT key, key AS at_key, began AS at, props, 0 AS moves FROM live
      UNION ALL
      SELECT w.key, p.up_key, p.up, l.props, w.moves + 1 FROM walk w
      JOIN parents p ON p.key = w.at_key AND p.began = w.at
      LEFT JOIN lives l ON l.key = p.up_key AND l.began = p.up
      WHERE w.props IS NULL)
    SELECT key AS user_id, live.op, live.commit_pos, live.value, found.props
    FROM live JOIN (SELECT key, max(props) AS props FROM walk GROUP BY 1) found USING (key)""")
def moved_key_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows whose omitted values follow them through chains of moved keys."""
    events = feed(spark, sf_dir)
    moved = F.col("event_type") == "purchase"
    key_only = F.array(text(F.col("user_id")), marked("n"), marked("n")).cast(TUPLE)
    sent = F.when(F.col("event_type").isin("click", "signup"), text(F.col("props"))).otherwise(marked("u"))
    user = F.col("user_id") + F.when(moved, 1).otherwise(0)
    dead = F.col("op") == "d"
    changes = log_rows(
        events,
        kind_of(F.col("op")),
        relation_id=F.lit(USERS),
        old_tuple=F.when(dead | moved, key_only),
        new_tuple=F.when(~dead, F.array(text(user), text(F.col("value")), sent).cast(TUPLE)),
    )
    rows = typed_rows(changes, USER_COLUMNS, USERS, old=["user_id"])
    return fill_moved(rows, ["user_id"], ["value", "props"]).select(
        "user_id", "op", "commit_pos", "value", "props"
    )
