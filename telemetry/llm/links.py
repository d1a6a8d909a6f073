"""Connected components of an edge table by alternating star contractions.

Each round rewrites edges so that every node points at the smallest node it sees; the
rounds needed grow with the logarithm of the longest chain. Rounds are written to the
shared folder, so a lost executor costs a reread. Nothing of the graph reaches the driver
but whether a round was the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry.llm.frames import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges, v any node -> (node, root): the smallest node reachable, for nodes of edges other than roots.

    Null ends and loops are ignored; repeated edges do no harm; no edges give no rows.
    """
    now = materialise(edges.filter("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    while True:
        now = materialise(_small_star(_large_star(now)), "edges")
        if _is_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down and no node that others point at has any."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")) \
        .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    seen = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return seen.filter("down > 1 or (down > 0 and up > 0)").isEmpty()
