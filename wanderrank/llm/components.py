"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before its shuffle) and an equi-join;
each round is written, so lineage stays short and no task or driver holds a
component. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderrank.llm.common import materialise, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    joined = down.join(low, F.col("a") == F.col("u"))
    return (joined.select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
        .select("e.a", "e.b").where("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the
    smallest node that links reach."""
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    if edges.isEmpty():
        release(edges)
        return edges.sparkSession.createDataFrame([], "node long, root long")
    sign = None
    while True:
        last, edges = edges, materialise(_small_star(_large_star(edges)), "stars")
        release(last)
        # sums of hashes: equal for equal edge sets
        r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not r["n"] or sign == (r["n"], r["h"]):
            break
        sign = (r["n"], r["h"])
    # the result reads the last round only; its files go with ``release`` of the result
    leaves = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    roots = edges.select(F.least("a", "b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    out = leaves.unionAll(roots)
    out._scratch = edges._scratch
    return out
