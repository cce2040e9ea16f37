"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

MOST_ROUNDS = 64


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    joined = both.join(least, "a").select("a", "b", F.least("a", "_m").alias("_m"))
    return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    others = links.join(least, "a").where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return others.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (``a``, ``b``); root is the smallest node it is connected to.

    Each round turns the links into lower stars and writes them; no node ever holds more links than the table
    had. Hot nodes are pre-aggregated where they are grouped, and joined by keys that adaptive execution splits.
    A null end, and a link of a node to itself, link nothing; an empty table has no nodes."""
    sized = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    state = materialize(sized.distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        mark = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == before or not mark[0]:
            break
        before = mark
        state = materialize(_small_star(_large_star(state)), "links")
    else:
        raise RuntimeError(f"links not settled in {MOST_ROUNDS} rounds")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
