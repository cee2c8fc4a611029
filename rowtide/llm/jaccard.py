"""Exact Jaccard self-join of documents' shingle sets, and its components.

Two sets link when their Jaccard similarity is at least 4/5. Every link between
different sets is found.

1. Equal sets are one class; a class is known by a 64-bit hash of its set.
2. Shingles are ordered by how many sets have them, as counted in `CELLS` hash
   cells over all documents, rarest first. Two sets that link share a shingle
   among the first n - ceil(4n/5) + 1 of each: the prefix. Sets meet in the
   groups of a prefix shingle.
3. They meet in tiles: a group's members by bands of size, as only sizes within
   4/5 can link, a large band in blocks. A tile holds a bounded number of sets. Its
   pairs are bounded from above by size, by place in the prefix, and by bitmaps.
4. Pairs that remain are decided inside the tiles, by intersecting the sorted
   arrays of shingles: members with a possible partner get their arrays, and a link
   counts in the group of the first shingle that its sets share, so each once. A
   tile sends a row for each linked member, with its number of links and the
   smallest set that it reaches there, never its pairs, and holds no list of them.

A bitmap keeps, for each of its bits, whether an odd number of the set's shingles
falls on it; the bits in which two bitmaps differ bound from below how many
shingles only one set has. Its length follows the set's size, and the longer of
two is folded to the shorter.

Null and empty texts, and texts without words, have an empty set and are linked
with nothing. Rows that share an id or are repeated are separate documents with
equal sets. An empty table gives no rows. Other columns are left out by
`link_components` and kept by `one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.components import components
from rowtide.llm.folders import few, stored
from rowtide.llm.shingles import SPACED, mixed, slices, text_shingles
from rowtide.llm.workers import ship

#: Hash cells in which shingles are counted; the table of counts is broadcast.
CELLS = 1 << 16
#: Sets in a block of a tile, and bytes of their shingles; a tile has at most two blocks.
BLOCK = 1_024
BLOCK_BYTES = 32 << 20
#: Sets of a group that are compared by size and place as they stream by.
SMALL_GROUP = 64
#: Bytes of text that are made into shingles at once, unless one text is longer.
TEXT_BYTES = 1 << 21
#: Sets whose texts' hashes are broadcast to find them again; more are joined by shuffling.
BROADCAST_SETS = 1_000_000
#: Earlier shingles that a prefix row knows of its set.
AHEAD = 8
#: Not used any more, as no pairs leave the tiles; a test sets it.
HUB_PAIRS = 256
#: Rows to be left out whose keys are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 200_000
LEAST_BITS, MOST_BITS = 64, 8_192


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for part in slices(texts, TEXT_BYTES):
        hashes, begins = text_shingles(part, SPACED)
        for a, b in zip(begins[:-1], begins[1:]):
            yield np.unique(hashes[a:b])


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = np.array([mixed(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))])
    return int(mixed(total).view(np.int64)[0])


def bitmap(shingles: np.ndarray) -> bytes:
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shingles that sets of these sizes must share: ceil(4 (a + b) / 9)."""
    return (4 * (a + b) + 8) // 9


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


_DESCRIBED = "kind int, doc_id bigint, text_hash bigint, n bigint, sid bigint, bits binary"


def described(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: each document's set; of kind 1: counts of cells (`sid`, `n`)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            sizes, sids, bits = [], [], []
            for shingles in sets_of(batch.column(2)):
                sizes.append(len(shingles))
                sids.append(set_hash(shingles) if len(shingles) else None)
                bits.append(bitmap(shingles) if len(shingles) else None)
                cells += np.bincount(_cell(shingles), minlength=CELLS)
            yield _table(0, batch.column(0), batch.column(1), sizes, sids, bits)
        seen = np.flatnonzero(cells)
        nothing = pa.nulls(len(seen), pa.int64())
        yield _table(1, nothing, nothing, cells[seen], seen, [None] * len(seen))

    return _named(docs).mapInArrow(describe, _DESCRIBED)


def _named(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _table(kind: int, doc_id, text_hash, n, sid, bits) -> pa.RecordBatch:
    columns = [
        pa.array(np.full(len(n), kind, np.int32)),
        doc_id,
        text_hash,
        pa.array(n, pa.int64()),
        pa.array(sid, pa.int64()),
        pa.array(bits, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["kind", "doc_id", "text_hash", "n", "sid", "bits"])


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """`token`, `sid`, `n`, `place`: the prefix of each set, once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = shared.value, set()
        for batch in batches:
            tokens, sids, sizes, places = [], [], [], []
            for shingles in sets_of(batch.column(2)):
                if not len(shingles) or (sid := set_hash(shingles)) in seen:
                    continue
                seen.add(sid)
                k = prefix_length(len(shingles))
                first = shingles[np.lexsort((shingles, cells[_cell(shingles)]))[:k]]
                tokens.append(first.view(np.int64))
                sids.append(np.full(k, sid))
                sizes.append(np.full(k, len(shingles), np.int32))
                places.append(np.arange(k, dtype=np.int32))
            if tokens:
                columns = [pa.array(np.concatenate(c)) for c in (tokens, sids, sizes, places)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "sid", "n", "place"])

    return _named(docs).mapInArrow(cut, "token bigint, sid bigint, n int, place int")


def shared_tokens(rows: DataFrame) -> DataFrame:
    """Prefix rows that may link with another set at their token, each set once.

    A task reads its sorted rows as a stream. In a group of up to `SMALL_GROUP`
    sets a row stays if size and place allow a link with another row of the
    group; the rows of a larger group all stay. Only the last group of a batch
    is held back, and of a large one no more than the batch's own rows.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        large: int | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            part = part.combine_chunks().filter(pa.array(_first_of_set(part)))
            token = part.column("token").to_numpy()
            last = int(np.searchsorted(token, token[-1]))
            if len(token) - last > SMALL_GROUP:
                # The group is large whatever follows: only its last set is held back.
                good = may_link_in_group(part, large)
                yield from part.slice(0, len(token) - 1).filter(pa.array(good[:-1])).to_batches()
                held, large = part.slice(len(token) - 1), int(token[-1])
            else:
                whole = part.slice(0, last)
                if last:
                    yield from whole.filter(pa.array(may_link_in_group(whole, large))).to_batches()
                if large is not None and large != int(token[-1]):
                    large = None
                held = part.slice(last)
        if held is not None:
            yield from held.filter(pa.array(may_link_in_group(held, large))).to_batches()

    ddl = "token bigint, sid bigint, n int, place int"
    return rows.repartition("token").sortWithinPartitions("token", "sid").mapInArrow(keep, ddl)


def _first_of_set(part: pa.Table) -> np.ndarray:
    token, sid = (part.column(c).to_numpy() for c in ("token", "sid"))
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    return new


def may_link_in_group(part: pa.Table, large: int | None) -> np.ndarray:
    """Rows, sorted by token, that may link with another row of their token.

    `large` is a token whose earlier rows made its group a large one.
    """
    token = part.column("token").to_numpy()
    n, place = (part.column(c).to_numpy().astype(np.int64) for c in ("n", "place"))
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    sizes = np.diff(np.append(starts, len(token)))
    good = np.repeat(sizes > SMALL_GROUP, sizes)
    if large is not None:
        good |= token == large
    small = np.flatnonzero(~good & (np.repeat(sizes, sizes) > 1))
    found = good.copy()
    most = int(sizes[sizes <= SMALL_GROUP].max(initial=1))
    for step in range(1, most):
        a = small[small + step < len(token)]
        a = a[token[a] == token[a + step]]
        b = a + step
        fit = 5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])
        fit &= np.minimum(n[a] - place[a], n[b] - place[b]) >= needed(n[a], n[b])
        found[a[fit]] = True
        found[b[fit]] = True
    return found


def differing(left: bytes, right: bytes) -> int:
    """Bits in which two bitmaps differ, the longer folded to the shorter."""
    if len(left) > len(right):
        left, right = right, left
    x, y = int.from_bytes(left, "little"), int.from_bytes(right, "little")
    width = len(left) * 8
    folded = 0
    while y:
        folded ^= y & ((1 << width) - 1)
        y >>= width
    return (x ^ folded).bit_count()


def tiled(members: DataFrame) -> DataFrame:
    """Members with the tiles they are in: `token`, `tile`, `side`.

    A group of one block is one tile. A larger one is cut by bands
    of size, a large band into blocks; blocks of the same or of neighbouring
    bands share a tile.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    parts = F.greatest(F.count("*") / BLOCK, F.sum(F.col("n").cast("bigint")) * 8 / BLOCK_BYTES)
    sizes = members.groupBy("token").agg(parts.alias("parts"))
    rows = members.join(sizes, "token")
    small = rows.filter(F.col("parts") <= 1).select(
        *members.columns, F.lit("").alias("tile"), F.lit(0).alias("side")
    )
    large = rows.filter(F.col("parts") > 1).withColumn("band", band)
    blocks = large.groupBy("token", "band").agg(F.ceil(parts).cast("int").alias("k"))

    def beside(step: int, name: str) -> DataFrame:
        return blocks.select("token", (F.col("band") - step).alias("band"), F.col("k").alias(name))

    counted = (
        large.join(blocks, ["token", "band"])
        .join(beside(1, "up"), ["token", "band"], "left")
        .join(beside(-1, "down"), ["token", "band"], "left")
        .withColumn("block", F.pmod(F.xxhash64("sid"), F.col("k")).cast("int"))
    )
    me = F.struct(F.col("band").alias("band"), F.col("block").alias("block"))

    def others(count, step: int):
        last = F.coalesce(count, F.lit(0)) - 1
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct((F.col("band") + step).alias("band"), i.alias("block"))),
        ).otherwise(F.array().cast("array<struct<band:int,block:int>>"))

    partners = F.concat(others(F.col("k"), 0), others(F.col("up"), 1), others(F.col("down"), -1))
    spread = counted.withColumn("other", F.explode(partners)).withColumn("me", me)
    name = F.to_json(F.struct(F.least("me", "other").alias("a"), F.greatest("me", "other").alias("b")))
    side = F.when(F.col("me") == F.col("other"), 0).when(F.col("me") < F.col("other"), 1).otherwise(2)
    return small.unionByName(spread.select(*members.columns, name.alias("tile"), side.alias("side")))


def by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each tile, of batches sorted by their first two columns, token and tile."""
    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns):
            if held and held[-1][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "tile").sortWithinPartitions("token", "tile", "n", "sid")


def survivors(rows: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """For the rows of a tile, sorted by size: a row, and later rows that may link with it.

    Columns: token, tile, n, sid, place, ahead, side, bits. `ahead` lists earlier
    shingles of the set's prefix; pairs that share one of these are left to its group.
    """
    if len(rows) < 2:
        return
    n = np.array([r[2] for r in rows], np.int64)
    rest = n - np.array([r[4] for r in rows], np.int64)
    ahead = np.zeros((len(rows), AHEAD), np.int64)
    has = np.zeros((len(rows), AHEAD), bool)
    for i, r in enumerate(rows):
        ahead[i, : len(r[5])], has[i, : len(r[5])] = r[5], True
    side = np.array([r[6] for r in rows])
    widths = np.array([len(r[7]) for r in rows])
    folded = {w: _folded(rows, widths, w) for w in np.unique(widths).tolist()}
    ends = np.searchsorted(n, n * 5 // 4, "right")
    for i in range(len(rows) - 1):
        j = np.arange(i + 1, ends[i])
        if not len(j):
            continue
        least = needed(n[i], n[j])
        good = np.minimum(rest[i], rest[j]) >= least
        if has[i].any():
            good &= ~(np.isin(ahead[j], ahead[i][has[i]]) & has[j]).any(axis=1)
        if side[i]:
            good &= side[j] != side[i]
        j, least = j[good], least[good]
        if not len(j):
            continue
        first, words = folded[int(widths[i])]
        differ = np.bitwise_count(words[j - first] ^ words[i - first]).sum(axis=1, dtype=np.int64)
        j = j[differ <= n[i] + n[j] - 2 * least]
        if len(j):
            yield i, j


_TILED = "token bigint, tile string, n int, sid bigint, place int, ahead array<bigint>, side int"


def candidates(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members of tiles, with their tile, that some other member of it may link with.

    `known` has each set's `bits`, and `first`, the earliest shingles of its prefix.
    """
    names = [c.split()[0] for c in _TILED.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_tile(batches):
            met = np.zeros(len(rows), bool)
            for i, j in survivors(rows):
                met[i] = True
                met[j] = True
            if met.any():
                columns = zip(*(rows[i][:7] for i in np.flatnonzero(met).tolist()))
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    earlier = F.filter("first", lambda t: t["place"] < F.col("place"))
    rows = tiled(members).join(known, "sid").withColumn("ahead", F.transform(earlier, lambda t: t["token"]))
    return _dealt(rows.select(*names, "bits")).mapInArrow(compare, _TILED)


def decided(docs: DataFrame, sets: DataFrame, met: DataFrame, counts: np.ndarray, pairs: bool) -> DataFrame:
    """Links within tiles, by intersecting sorted arrays; a set goes once to each of its tiles.

    A link belongs to the group of the first shingle, in the order of all, that
    its sets share, and is counted there alone. Each linked member of a tile gives
    one row: `sid`, `others` (rows that it links with) and `root`, the smallest set
    that it reaches inside the tile. With `pairs` the links themselves, `a`, `b`.
    """
    order = docs.sparkSession.sparkContext.broadcast(counts)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_tile(batches):
            arrays = [np.frombuffer(r[7], np.uint64) for r in rows]
            rows = [(*r[:7], bitmap(array), r[8]) for r, array in zip(rows, arrays)]
            token = np.array([rows[0][0]], np.int64).view(np.uint64)[0]
            links = (
                (i, [j for j in later.tolist() if _meet_first(arrays[i], arrays[j], token, order.value)])
                for i, later in survivors(rows)
            )
            sid = [r[3] for r in rows]
            if pairs:
                for i, later in filter(lambda link: link[1], links):
                    ends = [sorted((sid[i], sid[j])) for j in later]
                    columns = [pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b"])
                continue
            others, roots = _linked(sid, [r[8] for r in rows], links)
            if any(others):
                linked = [i for i, n in enumerate(others) if n]
                columns = [pa.array([x[i] for i in linked], pa.int64()) for x in (sid, others, roots)]
                yield pa.RecordBatch.from_arrays(columns, ["sid", "others", "root"])

    known = sets.select("sid", "copies")
    arrays = _arrays(docs, sets, met.select("sid").distinct())
    names = [c.split()[0] for c in _TILED.split(", ")]
    rows = met.join(known, "sid").join(arrays, "sid").select(*names, "shingles", "copies")
    return _dealt(rows).mapInArrow(decide, "a bigint, b bigint" if pairs else "sid bigint, others bigint, root bigint")


def _meet_first(left: np.ndarray, right: np.ndarray, token: np.uint64, counts: np.ndarray) -> bool:
    """Whether two sets link, and this is the first shingle that they share."""
    common = _common(left, right)
    if 9 * len(common) < 4 * (len(left) + len(right)):
        return False
    of = counts[_cell(common)]
    return common[of == of.min()].min() == token


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if len(left) > len(right):
        left, right = right, left
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    return left[right[at] == left]


def _linked(sid: list[int], copies: list[int], links: Iterator[tuple[int, list[int]]]) -> tuple[list[int], list[int]]:
    """For each row of a tile, the rows that it links with, and the smallest set that it reaches.

    The links of one row at a time are held; all of a tile grow with its square.
    """
    others, up = [0] * len(sid), list(range(len(sid)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, later in links:
        for j in later:
            others[i] += copies[j]
            others[j] += copies[i]
            a, b = find(i), find(j)
            if sid[a] <= sid[b]:
                up[b] = a
            else:
                up[a] = b
    return others, [sid[find(i)] for i in range(len(sid))]


def _folded(rows: list[tuple], widths: np.ndarray, width: int) -> tuple[int, np.ndarray]:
    """Bitmaps of all rows from the first of this width on, folded to it."""
    first = int(np.flatnonzero(widths >= width)[0])
    out = np.zeros((len(rows) - first, width // 8), np.uint64)
    for i in range(first, len(rows)):
        words = np.frombuffer(rows[i][7], np.uint64)
        if len(words) * 8 >= width:
            out[i - first] = np.bitwise_xor.reduce(words.reshape(-1, width // 8), axis=0)
    return first, out


def _arrays(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """`sid`, `shingles` of wanted sets. Their texts are found again by their hash."""
    hashes = sets.join(wanted, "sid").select("text_hash").distinct()
    small = hashes.limit(BROADCAST_SETS + 1).count() <= BROADCAST_SETS
    texts = _named(docs).join(F.broadcast(hashes) if small else hashes, "text_hash", "left_semi")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            sids, arrays = [], []
            for shingles in sets_of(batch.column(0)):
                if len(shingles) and (sid := set_hash(shingles)) not in seen:
                    seen.add(sid)
                    sids.append(sid)
                    arrays.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.int64()), pa.array(arrays, pa.binary())], ["sid", "shingles"]
            )

    # Tasks may each have sent a set; one is kept.
    return (
        texts.select("text")
        .mapInArrow(listed, "sid bigint, shingles binary")
        .groupBy("sid")
        .agg(F.first("shingles").alias("shingles"))
    )


def indexed(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The sets (`sid`, `text_hash`, `bits`, `copies`), their shared prefix rows, the counts of cells."""
    counts = np.zeros(CELLS, np.int64)
    cells = rows.filter("kind = 1").groupBy("sid").agg(F.sum("n").alias("n"))
    for cell, n in cells.collect():
        counts[cell] = n
    sets = (
        rows.filter("kind = 0 AND n > 0")
        .groupBy("sid")
        .agg(F.min("text_hash").alias("text_hash"), F.min("bits").alias("bits"), F.count("*").alias("copies"))
    )
    tokens = shared_tokens(prefixes(docs, counts))
    return sets, stored(tokens.repartition(few(docs.sparkSession)), "tokens"), counts


def tile_links(docs: DataFrame, rows: DataFrame, pairs: bool = False) -> DataFrame:
    """Every link between different sets: a row for each linked member of a tile, or the `pairs`.

    The shingles of all sets are in one order, so a pair meets at its first common
    one. The rows grow with the members of tiles, pairs with their square.
    """
    sets, tokens, counts = indexed(docs, rows)
    first = F.slice(F.array_sort(F.collect_list(F.struct("place", "token"))), 1, AHEAD)
    heads = tokens.groupBy("sid").agg(first.alias("first"))
    files = few(docs.sparkSession)
    met = candidates(tokens, sets.select("sid", "bits").join(heads, "sid"))
    met = stored(met.repartition(files), "candidates")
    links = decided(docs, sets, met, counts, pairs)
    return stored(links if pairs else links.repartition(files), "links")


def set_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """`node`, `root` of the sets that have links."""
    links = tile_links(docs, rows)
    return components(links.select(F.col("sid").alias("a"), F.col("root").alias("b")))


def link_components(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of each row."""
    rows = stored(described(docs), "sets")
    roots = set_links(docs, rows)
    found = _with_component(rows.filter("kind = 0"), roots)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id").coalesce(few(docs.sparkSession))


def class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links, between classes of equal sets, and the rows of each class.

    `a`, `b`: pairs of `class_id`, a class's hash, as many as there are links:
    they grow with the square of a group of near copies. `doc_id`, `n_shingles`,
    `class_id` of each row; a row without words has no class.
    """
    rows = stored(described(docs), "sets")
    members = rows.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("sid").alias("class_id"))
    return tile_links(docs, rows, pairs=True), members


def link_counts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, `class_id` and `n_links`, the other rows that each row links with."""
    rows = stored(described(docs), "sets")
    members = rows.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("sid").alias("class_id"))
    copies = members.groupBy("class_id").agg(F.count("*").alias("copies")).filter("class_id IS NOT NULL")
    links = tile_links(docs, rows).withColumnRenamed("sid", "class_id")
    others = links.groupBy("class_id").agg(F.sum("others").alias("others"))
    n_links = F.coalesce("others", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return (
        members.join(copies, "class_id", "left")
        .join(others, "class_id", "left")
        .select("doc_id", "n_shingles", "class_id", n_links.alias("n_links"))
    )


def _with_component(rows: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = rows.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "root", F.coalesce("root", "sid")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").withColumn(
        "component_id", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component: that of the smallest id, all columns kept.

    Equal ids are ordered by their text's hash, and of repeated rows one stays.
    Rows without words all stay.
    """
    rows = stored(described(docs), "sets")
    roots = set_links(docs, rows)
    rooted = _with_component(rows.filter("kind = 0 AND sid IS NOT NULL"), roots)
    key, files = F.struct("doc_id", "text_hash"), few(docs.sparkSession)
    counted = rooted.groupBy("root", key.alias("_key")).agg(F.count("*").alias("rows"))
    counted = stored(counted.coalesce(files), "component-rows")
    kept = counted.groupBy("root").agg(F.min("_key").alias("_kept"))
    kept_key = F.col("_kept") == F.col("_key")
    placed = counted.join(kept, "root")
    leave = stored(placed.filter(~kept_key).select("_key").coalesce(files), "left-out")
    repeated = placed.filter(kept_key & (F.col("rows") > 1)).select("_key")
    repeated = stored(repeated.coalesce(files), "repeated")
    own = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    out = docs.join(_hinted(leave), own == F.col("_key"), "left_anti")
    if repeated.isEmpty():
        return out
    once = out.join(_hinted(repeated), own == F.col("_key"), "left_anti")
    several = out.join(_hinted(repeated), own == F.col("_key"), "left_semi")
    first = several.withColumn("_llm_key", own).dropDuplicates(["_llm_key"]).drop("_llm_key")
    return once.unionByName(first)


def _hinted(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys
