"""Distributed union-find: connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.xxhash64("lo", "hi").bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def components(scratch: Scratch, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node it reaches.

    Each round hangs the larger neighbours of a node below the smallest neighbour
    (large star), then the smaller ones (small star); trees become stars in a
    number of rounds logarithmic in their depth. The minima are aggregates, merged in
    each task before they are shuffled, and are joined back from written tables, so
    that both join sides come straight from a shuffle and Spark can split a hot node.
    Links with a null end or equal ends connect nothing. No links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where((F.col(a) != F.col(b))).distinct()
    edges = scratch.keep(edges, "links")
    state = _state(edges)
    while state[0]:
        parents = scratch.keep(edges.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("top")), "parents")
        # The parent links stay, or large nodes would lose their smaller neighbours.
        large = scratch.keep(edges.join(parents, "lo", "left").select("hi", F.coalesce("top", "lo").alias("lo")), "large")
        tops = scratch.keep(large.groupBy("hi").agg(F.min("lo").alias("top")), "tops")
        small = large.join(tops, "hi")
        pairs = F.array(F.struct(F.col("hi").alias("hi"), F.col("top").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("top").alias("lo")))
        stars = small.select(F.explode(pairs).alias("p")).select("p.*").where("hi <> lo").distinct()
        after = scratch.keep(stars, "stars")
        new = _state(after)
        scratch.drop(parents, large, tops, edges)
        edges = after
        if new == state:
            break
        state = new
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select(F.col("lo"), F.col("lo")).distinct())
