"""Relation metadata in force at a position: an as-of join for change logs."""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from rowtide.operators.sizes import broadcast_if_small
from rowtide.schemas import RELATION_MSG
from rowtide.session import use_checkpoints

# A history of up to this many versions and bytes is held by every task.
LOCAL_VERSIONS = 5_000
LOCAL_BYTES = 32 * 1024 * 1024
# Versions of one relation that a change may be compared with.
CANDIDATES = 16
# Relations with more than one slice that every task may hold.
SLICED_RELATIONS = 500_000
# Announcements of one relation that one window sorts.
WINDOW_ROWS = 100_000

_BOUNDS = ("_from_pos", "_from_ord", "_to_pos", "_to_ord")
_END = 2**63 - 1


def position() -> Column:
    """Order of a change: commit position, then place in its transaction."""
    return F.struct("commit_pos", "ord")


def relation_versions(log: DataFrame) -> DataFrame:
    """Relation messages as `relation_id, relation, valid_from`."""
    return log.filter(F.col("kind") == RELATION_MSG).select(
        "relation_id", "relation", position().alias("valid_from")
    )


def described_versions(
    versions: DataFrame, pk: DataFrame | None = None, roots: DataFrame | None = None
) -> DataFrame:
    """Versions as `relation_id, valid_from, table, shape`.

    `table` is the published name and `shape` the JSON of `columns` and
    `key_columns`. `pk(table, pk_columns)` is the catalog's key, by published
    name; without it the key is the replica identity. `roots(table, root)`
    maps leaf partitions to their root, whatever the publication's setting.
    """
    named = versions.withColumn("table", F.concat_ws(".", "relation.namespace", "relation.name"))
    if roots is not None:
        named = (
            named.join(roots.select("table", "root"), "table", "left")
            .withColumn("table", F.coalesce("root", "table"))
            .drop("root")
        )
    flagged = F.filter("relation.columns", lambda c: c["flags"].bitwiseAND(1) == 1)
    key = F.transform(flagged, lambda c: c["name"])
    if pk is not None:
        named = named.join(pk.select("table", "pk_columns"), "table", "left")
        key = F.coalesce("pk_columns", key)
    shape = F.to_json(
        F.struct(F.col("relation.columns").alias("columns"), F.array_sort(key).alias("key_columns"))
    )
    return named.select("relation_id", "valid_from", "table", shape.alias("shape"))


class History:
    """Relation versions as validity intervals, ready to join to changes.

    Relations are announced again in every session, so repeats are dropped
    first. What is left is usually small: it is fetched behind a limit and
    broadcast. A longer history stays distributed, and the changes are shuffled
    to it once. Either way the join key is the relation and a slice of its own
    position range, with as many slices as keep the versions a change is
    compared with few; they also spread a hot relation over many join keys.
    Only relations with more than one slice are looked up, in a broadcast of
    checked size; the others need no lookup. A version is copied into each slice it reaches
    into: a relation's copies are at most its versions and its slices together,
    so what is broadcast is at most about twice what was checked.
    """

    def __init__(self, versions: DataFrame):
        self.attributes = [c for c in versions.columns if c not in ("relation_id", "valid_from")]
        per_shape = versions.groupBy("relation_id", *self.attributes).agg(
            F.min("valid_from").alias("valid_from"),
            F.max("valid_from.commit_pos").alias("last"),
            F.count("*").alias("n"),
        )
        text = F.concat_ws("", *[F.col(c).cast("string") for c in self.attributes])
        stats = (
            per_shape.groupBy("relation_id")
            .agg(
                F.count("*").alias("shapes"),
                F.sum("n").alias("n"),
                F.min("valid_from.commit_pos").alias("low"),
                F.max("last").alias("high"),
                F.max(F.length(text)).alias("width"),
            )
            .agg(F.max("shapes"), F.max("n"), F.min("low"), F.max("high"), F.max("width"))
            .first()
        )
        most_shapes, most, self.low, self.high, width = (v or 0 for v in stats)
        if most_shapes <= 1:
            changed = per_shape.select("relation_id", "valid_from", *self.attributes)
        else:
            changed = self._without_repeats(versions, most)
        allowed = min(LOCAL_VERSIONS, LOCAL_BYTES // max(width, 1))
        rows = changed.limit(allowed + 1).collect()
        self.rows: list[Row] | None = rows if len(rows) <= allowed else None
        if self.rows is None:
            # Used several times below, so it is computed once.
            use_checkpoints(versions.sparkSession)
            changed = changed.checkpoint()
            self.slicing = broadcast_if_small(_slicing(changed), SLICED_RELATIONS)
            self.frame = self._spread(self._intervals(changed))
        else:
            intervals = self._local_intervals(changed)
            self.slicing = None
            if max(Counter(r.relation_id for r in rows).values(), default=0) > CANDIDATES:
                self.slicing = F.broadcast(
                    _slicing(
                        intervals.select(
                            F.col("_relation_id").alias("relation_id"),
                            F.struct(F.col("_from_pos").alias("commit_pos")).alias("valid_from"),
                        )
                    )
                )
            self.frame = F.broadcast(self._spread(intervals))

    def attach(self, changes: DataFrame) -> DataFrame:
        """Changes with the attributes in force at their position, or NULLs."""
        pos, place = F.col("commit_pos"), F.col("ord")
        begun = (pos > F.col("_from_pos")) | (
            (pos == F.col("_from_pos")) & (place >= F.col("_from_ord"))
        )
        ended = (pos > F.col("_to_pos")) | ((pos == F.col("_to_pos")) & (place >= F.col("_to_ord")))
        return (
            self._sliced(changes, "relation_id", _slice=pos)
            .join(
                self.frame,
                (F.col("relation_id") == F.col("_relation_id"))
                & (F.col("_slice") == F.col("_version_slice"))
                & begun
                & ~ended,
                "left",
            )
            .drop("_slice", "_version_slice", "_relation_id", *_BOUNDS)
        )

    def _sliced(self, rows: DataFrame, relation: str, **places: Column) -> DataFrame:
        """Rows with the slice that each named position falls into."""
        if self.slicing is None:
            return rows.withColumns({name: F.lit(0).cast("bigint") for name in places})
        found = rows.join(self.slicing, F.col(relation) == F.col("_sliced"), "left")
        return found.withColumns({name: _slice_of(at) for name, at in places.items()}).drop(*_SLICING)

    def _without_repeats(self, versions: DataFrame, most: int) -> DataFrame:
        """Versions that differ from the one before, to within one per window."""
        windows = max(1, ceil(most / WINDOW_ROWS))
        width = max(1, ceil((self.high - self.low + 1) / windows))
        part = F.floor((F.col("valid_from.commit_pos") - self.low) / width)
        same = F.struct(*self.attributes)
        before = F.lag(same).over(
            Window.partitionBy("relation_id", "_part").orderBy("valid_from")
        )
        return (
            versions.withColumn("_part", part)
            .withColumn("_before", before)
            .filter(F.col("_before").isNull() | (F.col("_before") != same))
            .drop("_part", "_before")
        )

    def _local_intervals(self, changed: DataFrame) -> DataFrame:
        ordered = sorted(self.rows, key=lambda r: (r.relation_id, tuple(r.valid_from)))
        intervals = []
        for i, row in enumerate(ordered):
            following = ordered[i + 1] if i + 1 < len(ordered) else None
            end = (_END, 0)
            if following is not None and following.relation_id == row.relation_id:
                end = tuple(following.valid_from)
            intervals.append(
                (row.relation_id, *row.valid_from, *end, *[row[c] for c in self.attributes])
            )
        ddl = ", ".join(
            [f"{c} bigint" for c in ("_relation_id", *_BOUNDS)]
            + [f"`{c}` {changed.schema[c].dataType.simpleString()}" for c in self.attributes]
        )
        return changed.sparkSession.createDataFrame(intervals, ddl)

    def _intervals(self, changed: DataFrame) -> DataFrame:
        """Intervals without a window wider than a slice's versions.

        The next version is looked up inside the slice and, for the last one
        of a slice, in the relation's next occupied slice.
        """
        cut = self._sliced(changed, "relation_id", _cut=F.col("valid_from.commit_pos"))
        inside = Window.partitionBy("relation_id", "_cut").orderBy("valid_from")
        across = Window.partitionBy("relation_id").orderBy("_cut")
        first = cut.groupBy("relation_id", "_cut").agg(F.min("valid_from").alias("_first"))
        following = first.select(
            "relation_id", "_cut", F.lead("_first").over(across).alias("_next_first")
        )
        end = F.coalesce("_next", "_next_first")
        return (
            cut.withColumn("_next", F.lead("valid_from").over(inside))
            .join(following, ["relation_id", "_cut"])
            .select(
                F.col("relation_id").alias("_relation_id"),
                F.col("valid_from.commit_pos").alias("_from_pos"),
                F.col("valid_from.ord").alias("_from_ord"),
                F.coalesce(end["commit_pos"], F.lit(_END)).alias("_to_pos"),
                F.coalesce(end["ord"], F.lit(0)).alias("_to_ord"),
                *self.attributes,
            )
        )

    def _spread(self, intervals: DataFrame) -> DataFrame:
        """One row per interval and slice it reaches into."""
        sliced = self._sliced(
            intervals, "_relation_id", _first=F.col("_from_pos"), _last=F.col("_to_pos")
        )
        reached = F.explode(F.sequence("_first", "_last"))
        return sliced.withColumn("_version_slice", reached).drop("_first", "_last")


_SLICING = ("_sliced", "_low", "_width", "_slices")


def _slicing(versions: DataFrame) -> DataFrame:
    """How the position range of each relation with more than `CANDIDATES` versions is cut."""
    place = F.col("valid_from.commit_pos")
    ranges = versions.groupBy("relation_id").agg(
        F.min(place).alias("_low"), F.max(place).alias("_high"), F.count("*").alias("_n")
    )
    slices = F.ceil(F.col("_n") / CANDIDATES)
    width = F.greatest(F.ceil((F.col("_high") - F.col("_low") + 1) / slices), F.lit(1))
    return ranges.filter(F.col("_n") > CANDIDATES).select(
        F.col("relation_id").alias("_sliced"), "_low", width.alias("_width"), slices.alias("_slices")
    )


def _slice_of(commit_pos: Column) -> Column:
    """Slice of a position; 0 for relations that are not cut."""
    last = F.col("_low") + F.col("_width") * F.col("_slices") - 1
    inside = F.greatest(F.least(commit_pos, last), F.col("_low"))
    found = F.floor((inside - F.col("_low")) / F.col("_width")).cast("bigint")
    return F.when(F.col("_sliced").isNull(), F.lit(0).cast("bigint")).otherwise(found)


def relation_asof(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Attach to each change the newest relation version at or before it.

    `versions(relation_id, valid_from, <attributes>)`; a change of a relation
    not announced before it gets NULL attributes.
    """
    return History(versions).attach(changes)
