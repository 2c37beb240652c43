"""Connected components of a large graph, by rounds of star contraction.

Large-star hangs every larger neighbour of a node on the smallest node it knows of, small-star
hangs every smaller one there. Both keep components as they are, and after few rounds every
node hangs on the smallest of its component. Each round is a table in the shared folder, so
lineage stays short and the loss of an executor costs one round at most. A round takes as many
tasks as its edges ask for, about half a million each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinmart.workspace import stage

ROUNDS = 60
EDGES_A_TASK = 1 << 19


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low")).coalesce(tasks)
    hung = both.join(stage(least, "star-least"), "u").where("v > u")
    return hung.select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("low")).coalesce(tasks)
    least = stage(least, "star-least")
    hung = edges.join(least, "u").where("v > low")
    hung = hung.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return hung.unionByName(least.select("u", F.col("low").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of ``links`` with the smallest node of its component."""
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges, mark = stage(edges.distinct(), "star-edges"), None
    for _ in range(ROUNDS):
        sign = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = edges.agg(F.count(F.lit(1)).alias("n"), sign.alias("sign")).first()
        if (now["n"], now["sign"]) == mark or not now["n"]:
            break
        mark = (now["n"], now["sign"])
        tasks = -(-now["n"] // EDGES_A_TASK)
        for star in (_large_star, _small_star):
            hung = star(edges, tasks).coalesce(tasks).distinct().coalesce(tasks)
            edges = stage(hung, "star-edges")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
