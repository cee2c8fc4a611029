"""Omitted values that follow a row from key to key.

A change that moves a row to another key ends a life under the old key and
begins one under the new. A life is named by its key and the position at which
it began; it has at most one parent, the life that the row left. Values sent
during a life are aggregated once, and what a life did not send is looked up in
its ancestors by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowtide.operators.sizes import broadcast_if_small
from rowtide.operators.state import fill_omitted, orderable
from rowtide.schemas import DELETE, UPDATE
from rowtide.session import shared_dir

#: Where the life of a row begins that the log does not see begin.
UNSEEN = "named_struct('commit_pos', -1L, 'ord', -1L)"


def fill_moved(changes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Live rows; omitted values come from the row's past under all its keys.

    `changes` is the output of `typed_rows` with `old=key`. A row that moves to
    another key takes its values along and replaces what stood there. A later
    change of the key it left begins a new row. Keys that no move touches take
    the plain aggregate of `fill_omitted`; the rest is cut into lives.
    """
    # Read several times: decoded once, and the code generated for each pass stays small.
    changes = _stored(changes, "moved-changes")
    new = F.struct(*[F.col(f"`{c}`") for c in key])
    old = F.struct(*[F.col(f"`{c}__old`").alias(c) for c in key])
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(f"`{c}__old`").isNotNull()
    moved = (F.col("op") == UPDATE) & whole & (old != new)
    ends = changes.filter(moved).select(F.explode(F.array(old, new)).alias("_k"))
    touched = broadcast_if_small(ends.select("_k.*").distinct())
    resting = changes.join(touched, list(key), "left_anti")
    moving = changes.join(touched, list(key), "left_semi").select(
        "*", new.alias("_new"), F.when(moved, old).alias("_old")
    )
    lives = _climbed(_lives(_events(moving, columns), columns), columns)
    newest = lives.groupBy("key").agg(
        F.max_by(F.struct("last", *[f"_{c}" for c in columns]), "began").alias("_l")
    )
    live = newest.filter(F.col("_l.last.op") != DELETE).select(
        "key.*",
        F.col("_l.last.op").alias("op"),
        F.col("_l.last.at.commit_pos").alias("commit_pos"),
        F.col("_l.last.at.ord").alias("ord"),
        *[F.col("_l")[f"_{c}"]["value"].alias(c) for c in columns],
    )
    return fill_omitted(resting, key, columns).unionByName(live)


def _events(moving: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What happens to each key: a move is an end at one key and a beginning at the other.

    `cut` marks the events that begin another life, `went` the key that the row
    of an ended life has from then on.
    """
    values = [
        F.when((F.col("op") != DELETE) & F.col(f"`{c}__sent`"), F.struct(F.col(f"`{c}`").alias("value"))).alias(f"_{c}")
        for c in columns
    ]
    key_type = moving.schema["_new"].dataType
    nothing = F.lit(None).cast(key_type)
    here = F.struct(
        F.col("_new").alias("key"),
        "op",
        ((F.col("op") == DELETE) | F.col("_old").isNotNull()).alias("cut"),
        nothing.alias("went"),
        *values,
    )
    gone = F.struct(
        F.col("_old").alias("key"),
        F.lit(DELETE).alias("op"),
        F.lit(True).alias("cut"),
        F.col("_new").alias("went"),
        *[F.when(F.lit(False), v).alias(f"_{c}") for c, v in zip(columns, values)],
    )
    both = F.when(F.col("_old").isNotNull(), F.array(here, gone)).otherwise(F.array(here))
    at = F.struct("commit_pos", "ord").alias("at")
    return moving.select(at, F.explode(both).alias("_e")).select("at", "_e.*")


def _lives(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lives with their last event, the values they sent and their parent.

    Events are dealt in ranges of (key, position), so a key with very many of
    them is spread over ranges. A range knows its own cuts; the last cut of
    earlier ranges reaches it as one row, as only its first key can have begun
    in another range.
    """
    spark = events.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.repartitionByRange(ranges, "key", "at").withColumn("_range", F.spark_partition_id())
    # The number of a range must not change when a task is run again.
    dealt = _stored(dealt, "life-events")
    cut_at = F.when(F.col("cut"), F.col("at"))
    last_cuts = dealt.groupBy("_range", "key").agg(F.max(cut_at).alias("_cut"))
    earlier = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last_cuts.select("_range", "key", F.max("_cut").over(earlier).alias("_carried"))
        .filter("_carried IS NOT NULL")
    )
    within = Window.partitionBy("_range", "key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("_local", F.max(cut_at).over(within))
        # At most one row a range.
        .join(F.broadcast(carried), ["_range", "key"], "left")
        .withColumn("_before", F.coalesce("_local", "_carried", F.expr(UNSEEN)))
        .withColumn("began", F.when(F.col("cut"), F.col("at")).otherwise(F.col("_before")))
    )
    sent = [_last_sent(placed, c) for c in columns]
    lives = placed.groupBy("key", "began").agg(F.max(F.struct("at", "op")).alias("last"), *sent)
    parents = placed.filter("went IS NOT NULL").select(
        F.col("went").alias("key"),
        F.col("at").alias("began"),
        F.struct("key", F.col("_before").alias("began")).alias("up"),
    )
    return _stored(lives.join(parents, ["key", "began"], "left"), "lives")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once, by columns, in the folder that all executors share."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _last_sent(placed: DataFrame, column: str) -> Column:
    value = F.col(f"`_{column}`.value")
    sent = F.col(f"`_{column}`").isNotNull()
    pair = F.struct("at", value.alias("value"))
    typed = placed.select(value.alias("value"))
    last = F.max(F.when(sent, pair)) if orderable(typed, "value") else F.max_by(pair, F.when(sent, F.col("at")))
    return last.alias(f"_{column}")


def _climbed(lives: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lives with the nearest ancestor's value where they sent none themselves.

    Each round a life takes what its ancestor knows and that one's ancestor in
    its place: the rounds are the logarithm of the longest chain of moves. A
    parent began earlier than its child, so there is no cycle. Lives that know
    every value, or have no ancestor left, wait; a round stores the others alone.
    """
    names = [f"_{c}" for c in columns]
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    lives = lives.withColumn("up", F.when(missing, F.col("up")))
    settled, climbing = lives.filter("up IS NULL"), lives.filter("up IS NOT NULL")
    while not climbing.isEmpty():
        above = settled.unionByName(climbing).select(
            F.struct("key", "began").alias("up"), F.col("up").alias("_next"), *[F.col(n).alias(f"_up{n}") for n in names]
        )
        filled = climbing.join(above, "up", "left").select(
            "key", "began", "last", *[F.coalesce(n, f"_up{n}").alias(n) for n in names], F.col("_next").alias("up")
        )
        climbed = _stored(filled.withColumn("up", F.when(missing, F.col("up"))), "climbed")
        settled = settled.unionByName(climbed.filter("up IS NULL"))
        climbing = climbed.filter("up IS NOT NULL")
    return settled
