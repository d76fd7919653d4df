"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomchain.llm.common import cut, free, is_small, sent


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Links each node's larger neighbours to its smallest one (itself included)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    near = both.join(sent(least, small), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return near if small else near.distinct()


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(sent(least, small), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def contracted(edges: DataFrame, passes: int | None = None) -> DataFrame:
    """Links (a, b), a > b, that connect what ``edges(a, b)`` connect; without ``passes`` b is the smallest node that a reaches.

    Each round shortens paths by half at least and is written to the shared folder; the driver only compares two numbers.
    Few links are joined by sending their nodes to the tasks.  With more, a node with very many links is a star that the joins' skew handling splits; links
    only grow fewer from round to round.  With ``passes`` there are so many rounds.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    small, done = is_small(now), 0
    # Stars stay as they are, so that one round is enough for links that are stars already.
    before = None if passes else _mark(now)
    while done != passes:
        last, now = now, cut(_small_star(_large_star(now, small), small), "stars")
        free(last)
        done += 1
        if passes:
            continue
        mark = _mark(now)
        if mark == before:
            break
        before = mark
    return now


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def named(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes of contracted links."""
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``, numbers or structs of them; root is the smallest node reachable.

    Self-links and repeated edges do no harm; an empty table gives an empty one.
    """
    return named(contracted(edges))
