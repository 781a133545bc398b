"""Connected components and modularity clustering over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stage import stage


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, comp (least node): minimum labels with pointer jumps, each round on shared storage."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        low = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        step = stage(low.join(jump, "low").select("node", "old", F.least("low", "far").alias("comp")))
        labels = step.select("node", "comp")
        if step.where("old <> comp").isEmpty():
            return labels


def cluster_graph(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """edges(a, b, weight) -> node, cluster by synchronous label moves that raise modularity.

    Each round a node takes the neighbouring label of the largest weight less its expected weight;
    nodes of even and odd hash move in turn, so two neighbours do not swap labels."""
    both = stage(edges.select("a", "b", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    degree = stage(both.groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("k")))
    labels = degree.select("node", "k", F.col("node").alias("cluster"))
    for r in range(rounds):
        total = degree.agg(F.sum("k").alias("m2"))
        load = labels.groupBy("cluster").agg(F.sum("k").alias("load"))
        pull = both.join(labels.select(F.col("node").alias("b"), "cluster"), "b").groupBy(F.col("a").alias("node"), "cluster").agg(F.sum("weight").alias("w"))
        own = labels.select("node", "k", F.col("cluster").alias("own"))
        cand = pull.unionByName(own.select("node", F.col("own").alias("cluster"), F.lit(0.0).alias("w"))).groupBy("node", "cluster").agg(F.sum("w").alias("w"))
        gain = cand.join(own, "node").join(load, "cluster").crossJoin(F.broadcast(total))
        rest = F.col("load") - F.when(F.col("cluster") == F.col("own"), F.col("k")).otherwise(0.0)
        gain = gain.withColumn("gain", F.round(F.col("w") - F.col("k") * rest / F.col("m2"), 9))
        best = gain.groupBy("node", "k", "own").agg(F.max(F.struct("gain", (F.col("cluster") == F.col("own")).alias("stay"), (-F.col("cluster")).alias("low"))).alias("top"))
        turn = F.pmod(F.xxhash64("node"), F.lit(2)) == r % 2
        moved = stage(best.select("node", "k", "own", F.when(turn, -F.col("top.low")).otherwise(F.col("own")).alias("cluster")))
        labels = moved.select("node", "k", "cluster")
        if r % 2 and moved.where("own <> cluster").isEmpty():
            break
    return labels.select("node", "cluster")
