"""Connected components of a large graph by union-find over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.staging import stage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every end of ``links`` (a, b).

    Every node keeps a parent, no larger than itself. A round hooks the root of each link's
    larger end below the smallest root it is linked with, then halves all paths; links inside
    one tree fall away. A tree that has a link to a smaller root always moves, so the number of
    rounds grows with the logarithm of the longest path. Counts and minima are combined before
    rows move, so a node with very many links is no hot spot. Each round is a written table.
    """
    links = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    roots = stage(ends.select("node", F.col("node").alias("root")), "roots")
    open_ = links
    for _ in range(MAX_ROUNDS):
        side = roots.withColumnRenamed("node", "a").withColumnRenamed("root", "ra")
        other = roots.withColumnRenamed("node", "b").withColumnRenamed("root", "rb")
        placed = open_.join(side, "a").join(other, "b").where("ra <> rb")
        placed = placed.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        open_ = stage(placed, "open-links")
        if open_.isEmpty():
            return roots
        # Links now join roots; each root hooks below the smallest one linked with it.
        both = open_.union(open_.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("up"))
        hooks = stage(hooks.where("up < root"), "hooks")
        while True:  # follow hooks to their end: each step doubles the reach
            further = hooks.select(F.col("root").alias("up"), F.col("up").alias("top"))
            longer = hooks.join(further, "up", "left")
            moved = stage(longer.select("root", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "hooks")
            hooks = moved.drop("moved")
            if moved.where("moved").isEmpty():
                break
        joined = roots.join(hooks, "root", "left")
        roots = stage(joined.select("node", F.coalesce("up", "root").alias("root")), "roots")
    raise RuntimeError("components did not settle")
