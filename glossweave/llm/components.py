"""Connected components by alternating large and small stars, a few joins a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import materialise

#: Rounds before giving up; each at least halves the depth of what is left, so this is out of reach.
ROUNDS = 60


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("least", F.least("u", "least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    found = _with_least(down)
    moved = found.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(found.select("u", F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (u, v); root is the least node of its component, roots included.

    Nulls and loops among the edges are left out. Each round is a table in the shared folder.
    """
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components-0")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(now)
    for i in range(ROUNDS):
        if not before[0]:
            break
        now = materialise(_small_star(_large_star(now)), f"components-{i + 1}")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
