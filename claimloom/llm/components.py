"""Connected components by alternating star operations, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import stage

HEAVY_KEYS = 1000


def join_heavy(rows: DataFrame, per_key: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per key, whose column ``n`` counts the rows of that key.

    Keys with more than a ``HEAVY_KEYS``-th of ``total`` rows are fewer than
    ``HEAVY_KEYS``, so their side is broadcast and their rows stay where they
    are; all other keys are joined by a shuffle. ``n`` is not returned.
    """
    limit = total // HEAVY_KEYS
    heavy = F.broadcast(per_key.where(F.col("n") > limit).drop("n"))
    light = per_key.where(F.col("n") <= limit).drop("n")
    return rows.join(heavy, key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "leftanti").join(light, key))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    moved = join_heavy(both.where("v > u"), least, "u", 2 * total)
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = join_heavy(down, least, "u", total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(u, v)``; root is the smallest node it can reach.

    Rounds of a large and a small star until nothing changes (about the log of
    the node count). A node with a thousandth of all links or more is joined where
    its links are (``join_heavy``). Every round is written to the shared folder, so a lost
    executor costs one round at most; only three numbers per round reach the
    driver. Links to itself, repeated links and nulls are ignored; no link, no row.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stage(edges, "links")
    before = _mark(edges)
    while before[0]:
        edges = stage(_large_star(edges, before[0]), "stars")
        edges = stage(_small_star(edges, edges.count()), "stars")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
