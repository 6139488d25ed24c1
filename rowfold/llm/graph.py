"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.session import stage


def components(edges: DataFrame, work_dir: str, most_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``), ``root`` the smallest node it can reach.

    Rounds of two steps on the edges until nothing changes: first every node links its larger neighbours to its smallest
    neighbour, then its smaller ones; the edges turn into stars around the roots in a number of rounds that grows with
    the logarithm of the number of nodes. Smallest neighbours are found by a grouped minimum, which is reduced in the map
    tasks, so that a node with very many edges is no burden to one task. Each round is written to ``work_dir``.
    """
    loops = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    current = stage(loops.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), work_dir, "edges-0")
    before = None
    for turn in range(1, most_rounds + 1):
        both = current.filter("u != v").selectExpr("u", "v").unionByName(current.filter("u != v").selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # larger neighbours go to the smallest one
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v")
        large = large.unionByName(current.filter("u = v")).distinct()
        # smaller neighbours, and the node itself, go to the smallest one
        down = large.filter("u != v")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").filter("v != m").selectExpr("v AS u", "m AS v")
        small = small.unionByName(lowest.selectExpr("u", "m AS v")).unionByName(large.filter("u = v")).distinct()
        current = stage(small, work_dir, f"edges-{turn}")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = current.selectExpr("v AS node", "v AS root")
    return current.selectExpr("u AS node", "v AS root").unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
