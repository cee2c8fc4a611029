"""Connected components of a table of links, by large and small stars.

Every round links each node to the smallest neighbour it knows of; the rounds
end when nothing changes, after about as many as the logarithm of the longest
path. Each round is a grouped minimum, which combines on the map side, and a
join whose skewed keys Spark splits; a node with a third of all links stays a
pair of rows here. Rounds are written to the shared folder, in as many files as
their links ask for: no round has more links than the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.folders import few, stored

#: Links in a file of a round.
FILE_LINKS = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest node that each linked node reaches.

    `links` has the columns `a` and `b`; order, repeats and loops do not matter.
    """
    most = few(links.sparkSession)
    edges = stored(_ordered(links.select("a", "b")).coalesce(most), "links")
    before = _state(edges)
    while before[0]:
        stars = _small_star(_large_star(edges))
        edges = stored(stars.coalesce(min(most, -(-before[0] // FILE_LINKS))), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _ordered(links: DataFrame) -> DataFrame:
    """Links from the smaller to the larger node, once each."""
    return (
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Tells one set of links from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours get its smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _ordered(both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours get the smallest of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    near = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return _ordered(near.unionByName(least.select(F.col("m").alias("a"), "b")))
