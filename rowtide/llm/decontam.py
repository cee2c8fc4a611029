"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of item words: `window` of them, or a shorter item as a whole.
Its set is its word shingles, and a document contains the window only if it has
all of them. With full containment the necessary prefix of a set is one shingle;
taking the rarest one, counted over all documents, leaves the fewest candidates.
Documents are joined on these prefix shingles alone. A candidate must leave room
for the window before and after the shingle (length and position), and is then
compared word by word.

Words are runs of ASCII letters and digits and of all non-ASCII characters,
with A-Z in lower case. Null texts have no words. Each input row gives one
output row, also if it is repeated or has no id; items without words contain
nothing, items without an id count as hits but are not listed; an empty
benchmark hits nothing. Other columns are left out. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.folders import stored
from rowtide.operators.sizes import is_small

WINDOW = 13
SHINGLE = 5
#: Windows that are broadcast at once, each a few hundred bytes; more are joined by shuffling.
BROADCAST_WINDOWS = 50_000

# Fixed value: what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column = "text") -> Column:
    """The words of a text; none for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, SEPARATORS), "")


def shingle(words_: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words_), at + i) for i in range(size)])


def windows(items: DataFrame, window: int = WINDOW, size: int = SHINGLE) -> DataFrame:
    """Distinct windows: `words`, `length`, `size` of its shingles, and its `items`."""
    named = items.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w"))
    n = F.size("w")
    begins = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    cut = named.filter(n > 0).select("item", "w", F.explode(begins).alias("at"))
    cut = cut.select("item", F.slice("w", F.col("at") + 1, window).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).select(
        "words",
        F.size("words").alias("length"),
        F.least(F.lit(size), F.size("words")).alias("size"),
        F.array_sort("items").alias("items"),
    )


def with_prefix(cut: DataFrame, documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Windows with `prefix`, their rarest shingle, and `place`, where it stands in them.

    Shingles are counted over all documents; each task adds up its own first.
    """
    parts = []
    for k in sizes(cut):
        own = cut.filter(F.col("size") == k)
        at = F.explode(F.sequence(F.lit(0), F.col("length") - k)).alias("place")
        placed = own.select("*", at).withColumn("shingle", shingle("words", F.col("place"), k))
        wanted = placed.select("shingle").distinct()
        seen = shingled(documents, k).select("shingle")
        counts = seen.join(hinted(wanted), "shingle").groupBy("shingle").agg(F.count("*").alias("n"))
        rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "shingle"))
        parts.append(
            placed.join(counts, "shingle", "left")
            .groupBy("words", "length", "size", "items")
            .agg(rarest.alias("r"))
            .select("words", "length", "size", "items", "r.place", F.col("r.shingle").alias("prefix"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sizes(cut: DataFrame) -> list[int]:
    """Sizes of the windows' shingles: at most as many as a full one has words."""
    return sorted((r["size"] for r in cut.select("size").distinct().collect()), reverse=True) or [SHINGLE]


def shingled(documents: DataFrame, size: int) -> DataFrame:
    """A row for each shingle of each document, with its place `at`, beside all columns."""
    last = F.size("w") - size
    rows = documents.filter(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return rows.withColumn("shingle", shingle("w", F.col("at"), size))


def hinted(wanted: DataFrame) -> DataFrame:
    return F.broadcast(wanted) if is_small(wanted, BROADCAST_WINDOWS * WINDOW) else wanted


def occurrences(documents: DataFrame, prefixed: DataFrame) -> DataFrame:
    """Where windows occur: `key`, `start`, `length`, `items`."""
    found = None
    small = is_small(prefixed, BROADCAST_WINDOWS)
    for k in sizes(prefixed):
        own = prefixed.filter(F.col("size") == k).drop("size")
        part = _in_place(documents, own, k) if small else _shuffled(documents, own, k)
        found = part if found is None else found.unionByName(part)
    return found


def _bounded(start: Column, n: Column) -> Column:
    return (start >= 0) & (start + F.col("length") <= n)


def _same(start: Column) -> Column:
    return F.slice("w", start + 1, F.col("length")) == F.col("words")


def _in_place(documents: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """Candidates are compared where they are found; nothing is shuffled."""
    start = F.col("at") - F.col("place")
    rows = shingled(documents, k)
    joined = rows.join(F.broadcast(own), rows["shingle"] == own["prefix"])
    kept = joined.filter(_bounded(start, F.size("w"))).filter(_same(start))
    return kept.select("key", start.alias("start"), "length", "items")


def _shuffled(documents: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """Shingles meet prefixes by shuffling; candidates go back to the words once."""
    numbered = own.withColumn("window", F.xxhash64("words"))
    rows = shingled(documents, k).select("key", F.size("w").alias("n"), "at", "shingle")
    prefixes = numbered.select(F.col("prefix").alias("shingle"), "place", "length", "window")
    start = F.col("at") - F.col("place")
    near = rows.join(prefixes, "shingle").filter(_bounded(start, F.col("n")))
    near = near.select("key", start.alias("start"), "window").distinct()
    full = near.join(numbered.select("window", "words", "length", "items"), "window")
    texts = documents.groupBy("key").agg(F.first("w").alias("w"))
    kept = full.join(texts, "key").filter(_same(F.col("start")))
    return kept.select("key", "start", "length", "items")


def covered(spans: Column) -> Column:
    """How many places the spans cover together."""

    def add(acc: Column, s: Column) -> Column:
        begin, end = F.greatest(s["start"], acc["to"]), s["start"] + s["length"]
        return F.struct(
            (acc["n"] + F.greatest(end - begin, F.lit(0))).cast("bigint").alias("n"),
            F.greatest(acc["to"], end).cast("bigint").alias("to"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart: equal keys are repeated rows."""
    return F.struct(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, size: int = SHINGLE
) -> DataFrame:
    """`key`, `rows`, `n_words`, `n_hit`, `n_items`, `items_sha256` and `contaminated`.

    One row for each distinct document row; `rows` says how often it occurs.
    """
    documents = docs.select(row_key().alias("key"), words("text").alias("w"))
    cut = stored(windows(items, window, size), "windows")
    prefixed = stored(with_prefix(cut, documents, size), "prefixes")
    found = occurrences(documents, prefixed)
    nothing = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("start", "length", "items")]
    every = documents.select("key", F.size("w").alias("n"), *nothing)
    both = every.unionByName(found.withColumn("n", F.lit(None).cast("int")))
    span = F.when(F.col("start").isNotNull(), F.struct("start", "length"))
    grouped = both.groupBy("key").agg(
        F.count("n").alias("rows"),
        F.max("n").cast("bigint").alias("n_words"),
        F.collect_set(span).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    listed = grouped.select(
        "key",
        "rows",
        "n_words",
        covered(F.col("spans")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )
    return listed.select(
        "key",
        "rows",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document."""
    found = contamination(docs, items)
    each = found.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    return each.select(
        "key.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the contaminated rows; all columns stay."""
    bad = contamination(docs, items).filter("contaminated").select(F.col("key").alias("_bad"))
    # Structs compare with their nulls, so a row without an id is found too.
    return docs.join(bad, row_key() == F.col("_bad"), "left_anti")
