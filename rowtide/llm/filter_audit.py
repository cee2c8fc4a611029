"""What each filter of a quality cascade removes, in every order of the filters.

A document's failure mask tells which filters it fails. Masks do not depend on
the order in which filters are applied, so Spark counts documents by part and
mask: at most 2^n rows a part, however many documents there are. Each part's
counts become a decision diagram: one level per filter, a passing and a failing
edge from every node, counts at the ends, equal subgraphs shared. A node's weight
is the count below it. The path that passes every filter meets, at each level,
what that filter removes (the failing edge) and keeps (the passing edge). All
orders are visited by swapping two adjacent levels at a time, which rebuilds
those two levels only.

Results: null texts are empty, null parts the empty string. A document is a copy
if a row of a smaller id has the same text, wherever that row ends up; rows
without an id, and rows that share the smallest id, are copies of nothing, and a
row without an id makes no other row a copy. Texts are compared by their sha256.
A document is good or toxic if any label row of its id says so. Every row counts
once, repeated ones too. A part without documents has no rows; an empty table
gives none. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.folders import stored
from rowtide.llm.workers import ship
from rowtide.operators.sizes import is_small

#: The filters of `text_failures` and `failures`, by the bits of a mask.
FILTERS = "ABCDE"
COPY = FILTERS.index("E")

# What separates words, and the characters that fail D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"

_STEPS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_failures(text: Column) -> Column:
    """Bits of the filters that need the text alone."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    n = F.size(words)
    failing = [
        n < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        text.rlike(MARKS),
    ]
    bits = F.lit(0)
    for i, fails in enumerate(failing):
        bits = bits + F.when(fails, 1 << i).otherwise(0)
    return bits


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """`doc_id`, `part`, `mask`, `good`, `toxic` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text")
    )
    bits, digest = text_failures(F.col("text")), F.unhex(F.sha2("text", 256))
    rows = stored(rows.select("doc_id", "part", bits.alias("bits"), digest.alias("digest")), "failures")

    # Few texts occur twice; the others need no partner.
    first = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    first = stored(first.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "first")
    rows = rows.join(F.broadcast(first) if is_small(first) else first, "digest", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << COPY).otherwise(0)
    rows = rows.select("doc_id", "part", (F.col("bits") + copy).alias("mask"))

    told = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("quality").eqNullSafe(1).cast("int")).alias("good"),
        F.max(F.col("toxic").eqNullSafe(1).cast("int")).alias("toxic"),
    )
    told = told.filter("good + toxic > 0")
    return rows.join(told, "doc_id", "left").na.fill(0, ["good", "toxic"])


def mask_counts(rows: DataFrame) -> DataFrame:
    """Documents, good and toxic ones, by `part` and `mask`."""
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, for each part of `rows`.

    `filters` has a letter for each bit of `mask`. The table has n * n! rows a
    part, so n is meant to be small.
    """

    def steps(counts: pd.DataFrame) -> pd.DataFrame:
        masks = counts["mask"].tolist()
        weights = zip(counts["n"].tolist(), counts["good"].tolist(), counts["toxic"].tolist())
        out = part_steps(dict(zip(masks, weights)), filters)
        return pd.DataFrame(
            [(counts["part"].iloc[0], *row) for row in out], columns=[c.split()[0] for c in _STEPS.split(", ")]
        )

    ship(rows.sparkSession)
    return mask_counts(rows).groupBy("part").applyInPandas(steps, _STEPS)


Weight = tuple[int, int, int]
NOTHING: Weight = (0, 0, 0)


def plus(a: Weight, b: Weight) -> Weight:
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2])


class Diagram:
    """A decision diagram over failure masks whose nodes weigh what lies below them.

    Node 0 is the empty one of every level. The others of a level have children
    one level further down, a passing and a failing one, and no two of them the
    same pair.
    """

    def __init__(self, counts: dict[int, Weight], variables: int):
        self.order = list(range(variables))
        self.weight: list[Weight] = [NOTHING]
        self.children: list[tuple[int, int]] = [(0, 0)]
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(variables)]
        ends: dict[Weight, int] = {NOTHING: 0}
        for weight in counts.values():
            if weight not in ends:
                ends[weight] = self._add((0, 0), weight)
        self.root = self._build(0, {mask: ends[w] for mask, w in counts.items()})

    def _add(self, pair: tuple[int, int], weight: Weight) -> int:
        self.children.append(pair)
        self.weight.append(weight)
        return len(self.weight) - 1

    def _node(self, level: int, pair: tuple[int, int]) -> int:
        if pair == (0, 0):
            return 0
        known = self.levels[level]
        if pair not in known:
            known[pair] = self._add(pair, plus(self.weight[pair[0]], self.weight[pair[1]]))
        return known[pair]

    def _build(self, level: int, ends: dict[int, int]) -> int:
        if not ends:
            return 0
        if level == len(self.order):
            (end,) = ends.values()
            return end
        bit = 1 << self.order[level]
        passing = self._build(level + 1, {m: e for m, e in ends.items() if not m & bit})
        failing = self._build(level + 1, {m: e for m, e in ends.items() if m & bit})
        return self._node(level, (passing, failing))

    def swap(self, level: int) -> None:
        """Exchange a level with the next; nodes above keep their children."""
        upper = self.levels[level]
        self.levels[level], self.levels[level + 1] = {}, {}
        for (passing, failing), node in upper.items():
            (pp, pf), (fp, ff) = self.children[passing], self.children[failing]
            pair = (self._node(level + 1, (pp, fp)), self._node(level + 1, (pf, ff)))
            self.children[node] = pair
            self.levels[level][pair] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Filter, what it keeps and what it removes, along the path that passes all."""
        node = self.root
        for variable in self.order:
            passing, failing = self.children[node]
            yield variable, self.weight[passing], self.weight[failing]
            node = passing


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places to swap with their successor so that all orders of n things are met once."""
    if n < 2:
        return
    rest: Iterable[int | None] = [*adjacent_swaps(n - 1), None]
    for turn, place in enumerate(rest):
        down = turn % 2 == 0
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if place is not None:
            yield place + 1 if down else place


def part_steps(counts: dict[int, Weight], filters: str) -> list[tuple]:
    """Rows of one part: order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    n = len(filters)
    failing = [sum(w[0] for mask, w in counts.items() if mask >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, NOTHING)[0] for f in range(n)]
    removed_ever = [0] * n
    diagram = Diagram(counts, n)
    steps = []
    for place in [None, *adjacent_swaps(n)]:
        if place is not None:
            diagram.swap(place)
        order = "".join(filters[v] for v in diagram.order)
        for step, (f, kept, removed) in enumerate(diagram.all_pass(), 1):
            removed_ever[f] += removed[0]
            steps.append((order, step, f, kept[0], removed))
    return [
        (order, step, kept, lost[0], failing[f] - lost[0], alone[f], lost[1], lost[2], removed_ever[f])
        for order, step, f, kept, lost in steps
    ]
