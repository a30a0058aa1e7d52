"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import checkpointed

# A round runs on one task for so many links, without a shuffle while one task will do.
LINKS_PER_TASK = 1 << 16


def _low(edges: DataFrame) -> DataFrame:
    """The smallest node next to each u, u itself included. Combined before the shuffle, so a
    node with a third of all links is no load for one task."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))


def _each(edges: DataFrame, *links: tuple[Column, Column]) -> DataFrame:
    """Several links (u, v) out of every row."""
    pairs = F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in links])
    return edges.select(F.explode(pairs).alias("link")).select("link.*")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node that
    can be reached. Nodes that are their own component need not be listed.

    Each round hangs larger neighbours, then smaller ones, on the smallest neighbour; both
    are joins with a pre-aggregated minimum, and neighbours are never gathered in a list.
    Rounds grow with the logarithm of the longest chain. Nulls and self links are ignored;
    without links the result is empty.
    """
    u, v, low = F.col("u"), F.col("v"), F.col("low")
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _print(edges)
    while before[0]:
        edges = edges.coalesce(before[0] // LINKS_PER_TASK + 1)
        both = _each(edges, (u, v), (v, u))
        large = both.join(_low(both), "u").where(v > u).select(v.alias("u"), low.alias("v"))
        small = _each(large.join(_low(large), "u"), (v, low), (u, low)).where(u != v).distinct()
        edges = checkpointed(small)
        after = _print(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
