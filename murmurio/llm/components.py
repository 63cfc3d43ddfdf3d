"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmurio.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge (a, b) to another; root is the smallest node.

    Alternates the large-star and small-star steps: every step links each node's neighbours to
    the smallest of them, so the number of edges never grows and a component becomes a star after
    a logarithmic number of rounds. With edges from the larger to the smaller node, the large star
    moves only edges to nodes with a smaller neighbour of their own, here two steps down at once.
    A round that met no third step and no node with two smaller ones has left stars behind, so no
    further one has to confirm it. Every round is written to the shared folder once, so neither the
    lineage nor the driver holds the graph. No edges give no rows.
    """
    a, b, m = F.col("a"), F.col("b"), F.col("m")
    now = materialize(edges.where(a != b).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct().withColumn("more", F.lit(True)), "edges")
    while now.where("more").take(1):
        down = (now.groupBy("a").agg(F.min("b").alias("m"))
                .join(now.select(b.alias("_hub")).distinct(), a == F.col("_hub"), "left_semi"))
        twice = down.join(down.select(a.alias("_m"), m.alias("_m2")), m == F.col("_m"), "left").select(
            a.alias("_a"), F.coalesce("_m2", "m").alias("m"), F.col("_m2").isNotNull().alias("far"))
        large = now.select("a", "b").join(twice, b == F.col("_a"), "left").select(
            "a", F.coalesce("m", "b").alias("b"), F.coalesce("far", F.lit(False)).alias("far"))
        large = large.repartition("a").groupBy("a", "b").agg(F.bool_or("far").alias("far"))
        large = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        now = materialize(large.select(F.when(b == m, a).otherwise(b).alias("a"), m.alias("b"),
                                       (F.col("far") | (b != m)).alias("more"))
                          .groupBy("a", "b").agg(F.bool_or("more").alias("more")), "edges")
    return now.select(a.alias("node"), b.alias("root")).unionAll(
        now.select(b.alias("node"), b.alias("root")).distinct())
