"""Packing of documents into sequences, by a configuration linear program.

A configuration is a multiset of piece lengths that fits in one sequence. The
linear program "cover every length's count with as few configurations as
possible" is solved by multiplicative weights: each length has a weight that
falls as it is covered, and a knapsack over the weights prices the next
configuration, until every length is covered and the number of sequences is
within `GAP` of a lower bound. Best fit places the pieces of sequences with room
anew when that takes fewer sequences. The program sees the histogram of lengths alone, at most `CAPACITY`
numbers however many documents there are; Spark counts the histogram and gives
every piece its place.

Results: a null or empty text is one piece with the end id; repeated rows and
repeated ids are packed as they come, each row once; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowtide.llm.folders import stored
from rowtide.llm.tokens import ids_with_end
from rowtide.llm.workers import ship

CAPACITY = 4096
#: Share by which the program's sequences may exceed the lower bound before it goes on.
GAP = 0.02
#: Lengths among which a round prices its configuration.
PRICED = 96
#: Power of the length in a starting weight: long pieces first, short ones are kept to fill gaps.
LONG_FIRST = 2.0
#: Pieces whose rank is settled by one sort.
BUCKET_ROWS = 4_000

_PIECES = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, words_apart: bool = True
) -> DataFrame:
    """Pieces of at most `capacity` ids, with the crc32 of their ids.

    `row` tells apart rows that share a `doc_id`.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            doc_ids, rows = (batch.column(i).to_pylist() for i in range(2))
            for doc_id, row, ids in zip(doc_ids, rows, ids_with_end(tokenizer, batch.column(2), words_apart)):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    crc = zlib.crc32(part.astype("<u4", copy=False))
                    out.append((doc_id, row, piece, start, len(part), crc))
            names = ("doc_id", "row", "piece", "start", "length", "ids_crc32")
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names)
            )

    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), "text"
    )
    return rows.mapInArrow(cut, _PIECES)


@dataclass
class Run:
    """`times` sequences that hold the same lengths: (length, count) pairs."""

    lengths: tuple[tuple[int, int], ...]
    times: int


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> list[Run]:
    """Sequences for a histogram of lengths: the program's, which cover all pieces.

    What rounding leaves is the pieces of sequences with room: best fit places these
    anew, beside the program's full sequences, when that takes fewer.
    """
    demand = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        demand[length] = count
    runs = [Run(lengths, times) for lengths, times in configurations(demand, capacity, gap)]
    full = [r for r in runs if sum(n * k for n, k in r.lengths) == capacity]
    left = demand.copy()
    for run in full:
        for n, k in run.lengths:
            left[n] -= k * run.times
    return min(runs, full + best_fit(left, capacity), key=lambda x: sum(r.times for r in x))


def configurations(
    demand: np.ndarray, capacity: int, gap: float = GAP
) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Configurations and how often each is used: together they cover the demand.

    Passes of multiplicative weights. A pass prices one configuration a round,
    uses it for at most the share `step` of any of its lengths' counts (or
    once), lets these lengths' weights fall exponentially with their covered
    part, and ends when every length is covered. Uses are whole numbers, so that
    rounding leaves nothing. The pass with the fewest sequences stands. The next
    begins with prices that are raised for lengths in sequences with room. Steps
    halve until it is within `gap` (or one sequence) of the greatest lower bound
    known, or until a step is less than `gap`; a pass has at most the number of
    lengths divided by its step rounds.
    """
    sizes = np.flatnonzero(demand)
    if not len(sizes):
        return []
    least = lower_bound(demand, capacity)
    found: list[tuple[tuple[tuple[int, int], ...], int]] = []
    total = math.inf
    step, start = 1.0, sizes**LONG_FIRST
    while step >= gap:
        use, weight = cover(sizes, demand[sizes], capacity, step, start)
        if sum(use.values()) < total:
            found, total = list(use.items()), sum(use.values())
        if total > max(least * (1 + gap), least + 1):
            # The weights are prices: no cover costs less than the demand at these.
            most = np.minimum(demand[sizes], capacity // sizes)
            value = dict(zip(sizes.tolist(), weight.tolist()))
            dearest = sum(value[n] * k for n, k in priced(sizes, weight, capacity, most))
            least = max(least, math.ceil(float(demand[sizes] @ weight) / dearest - 1e-6))
        if total <= max(least * (1 + gap), least + 1):
            break
        step /= 2
        paid = np.zeros(capacity + 1)
        for lengths, times in use.items():
            share = capacity * times / sum(n * k for n, k in lengths)
            for n, k in lengths:
                paid[n] += share * k
        start = start * paid[sizes] / demand[sizes]
    return sorted(found, key=lambda x: -x[1])


def cover(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, step: float, start: np.ndarray
) -> tuple[dict[tuple[tuple[int, int], ...], int], np.ndarray]:
    """One pass: uses of configurations that cover all counts, and the mean weights."""
    use: dict[tuple[tuple[int, int], ...], int] = defaultdict(int)
    left = counts.copy()
    rate = math.log(len(sizes) + 1) / math.sqrt(step)
    prices = np.zeros(len(sizes))
    while left.any():
        weight = start * np.exp(-rate * (1 - left / counts))
        at = candidates(left, weight / sizes)
        lengths = priced(sizes[at], weight[at], capacity, left[at])
        own = np.searchsorted(sizes, [n for n, _ in lengths])
        per = np.array([k for _, k in lengths])
        times = max(1, int(min((left[own] // per).min(), step * (counts[own] / per).min())))
        use[lengths] += times
        left[own] -= per * times
        prices += weight * (times / float(weight[own] @ per))
    return use, prices


def candidates(left: np.ndarray, density: np.ndarray) -> np.ndarray:
    """Lengths that a round prices: all that are left, or `PRICED` of them.

    Half are those of the greatest weight a token, half are spread over all
    sizes. Other rounds see others, as weights fall and lengths are used up.
    """
    at = np.flatnonzero(left)
    if len(at) <= PRICED:
        return at
    dense = at[np.argpartition(-density[at], PRICED // 2)[: PRICED // 2]]
    spread = at[np.linspace(0, len(at) - 1, PRICED // 2).astype(int)]
    return np.union1d(dense, spread)


def lower_bound(demand: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs.

    For each k: pieces longer than `capacity` - k have a sequence each, in which
    no piece of k or longer fits; the pieces from k up need room beside them.
    """
    counts = demand.astype(np.int64)
    tokens = np.cumsum(counts * np.arange(capacity + 1))
    pieces = np.cumsum(counts)
    k = np.arange(1, capacity // 2 + 1)
    alone = pieces[capacity] - pieces[capacity - k]
    between = tokens[capacity - k] - tokens[k - 1]
    return int(max(-(-tokens[capacity] // capacity), (alone - (-between // capacity)).max(initial=0)))


def priced(
    sizes: np.ndarray, weight: np.ndarray, capacity: int, most: np.ndarray
) -> tuple[tuple[int, int], ...]:
    """The configuration of greatest weight: a bounded knapsack by dynamic programming.

    A length that may be used k times stands as items of 1, 2, 4, ... pieces.
    """
    items: list[tuple[int, int, float]] = []
    for size, value, k in zip(sizes.tolist(), weight.tolist(), np.minimum(most, capacity // sizes).tolist()):
        many = 1
        while k > 0:
            many = min(many, k)
            items.append((size, many, value * many))
            k -= many
            many *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for i, (size, many, value) in enumerate(items):
        room = size * many
        with_it = best[: capacity + 1 - room] + value
        np.greater(with_it, best[room:], out=taken[i, room:])
        np.maximum(with_it, best[room:], out=best[room:])
    chosen: dict[int, int] = defaultdict(int)
    room = capacity
    for i in range(len(items) - 1, -1, -1):
        if taken[i, room]:
            chosen[items[i][0]] += items[i][1]
            room -= items[i][0] * items[i][1]
    return tuple(sorted(chosen.items(), reverse=True))


def best_fit(left: np.ndarray, capacity: int) -> list[Run]:
    """Best fit, longest first, on groups of sequences that look alike."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    rooms = np.zeros(capacity + 1, np.int64)

    def put(room: int, lengths: tuple[tuple[int, int], ...], n: int) -> None:
        by_room[room][lengths] += n
        rooms[room] += n

    def added(lengths: tuple[tuple[int, int], ...], size: int, k: int = 1) -> tuple:
        if lengths and lengths[-1][0] == size:
            return (*lengths[:-1], (size, lengths[-1][1] + k))
        return (*lengths, (size, k))

    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n > 0:
            fits = np.flatnonzero(rooms[size:])
            if not len(fits):
                per = capacity // size
                full, rest = divmod(n, per)
                if full:
                    put(capacity - per * size, ((size, per),), full)
                if rest:
                    put(capacity - rest * size, ((size, rest),), 1)
                n = 0
                continue
            room = size + int(fits[0])
            lengths, there = by_room[room].popitem()
            # As many into each sequence as fit, but no more than there are.
            per = max(1, min(room // size, n // there)) if there <= n else 1
            moved = min(there, n // per)
            rooms[room] -= there
            if there > moved:
                put(room, lengths, there - moved)
            put(room - per * size, added(lengths, size, per), moved)
            n -= moved * per
    return [Run(lengths, n) for group in by_room.values() for lengths, n in group.items()]


def slots(runs: list[Run]) -> dict[int, np.ndarray]:
    """By length: first rank, pieces a sequence, first sequence, first offset."""
    table: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for run in runs:
        offset = 0
        for length, count in run.lengths:
            table[length].append((ranks[length], count, sequence, offset))
            ranks[length] += count * run.times
            offset += length * count
        sequence += run.times
    return {length: np.array(rows, np.int64) for length, rows in table.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank among those of the same length.

    A length may be that of a third of all pieces: pieces are dealt into buckets
    of a few thousand, each bucket counts its lengths, and a piece's rank is the
    count of the buckets before plus its place within its own.
    """
    buckets = max(1, math.ceil(pieces.count() / BUCKET_ROWS))
    dealt = pieces.withColumn("_b", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_b", "length").agg(F.count("*").alias("_n"))
    starts = counts.select(
        "_b", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_b", "length").orderBy("row", "piece")
    return (
        dealt.withColumn("_i", F.row_number().over(within) - 1)
        .join(starts, ["_b", "length"])
        .withColumn("rank", F.col("_before") + F.col("_i"))
        .drop("_b", "_i", "_before")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (stored, with `length`) with `sequence_id` and `offset`."""
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan_runs(histogram, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sequence = np.empty(len(rows), np.int64)
            offset = np.empty(len(rows), np.int64)
            rank = rows["rank"].to_numpy()
            for length, at in rows.groupby("length").indices.items():
                spans = table[int(length)]
                span = spans[np.searchsorted(spans[:, 0], rank[at], "right") - 1]
                turn, place_ = np.divmod(rank[at] - span[:, 0], span[:, 1])
                sequence[at] = span[:, 2] + turn
                offset[at] = span[:, 3] + place_ * length
            yield rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ddl = f"{_PIECES}, sequence_id bigint, offset bigint"
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return ranked(pieces).select(*names, "rank").mapInPandas(place, ddl).drop("row")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, words_apart: bool = True
) -> DataFrame:
    """Pieces of all documents and their places. Texts are encoded once."""
    return pack(stored(cut_pieces(docs, tokenizer, capacity, words_apart), "pieces"), capacity)
