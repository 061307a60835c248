"""Connected components by alternating stars, as joins and grouped minima over stored edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stored

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node that it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    handed = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v")))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long), the root being its smallest reachable node.

    A node without edges does not occur. Rounds are stored in ``folder``; a node with very many edges is
    one partial minimum per task, and its join is one that adaptive execution splits.
    """
    spark = edges.sparkSession
    now = stored(_tidy(edges.select("u", "v")), folder, "stars0")
    seen = _print(now)
    for i in range(1, MAX_ROUNDS):
        after = stored(_tidy(_small_star(_tidy(_large_star(now)))), folder, f"stars{i}")
        found = _print(after)
        drop(spark, f"{folder}/stars{i - 1}")
        now = after
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError("components did not settle")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
