"""Connected components of a graph given as rows, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventbase.llm.common import settle


def _toward_smallest(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or smaller) neighbours of each node to the smallest of its neighbourhood."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = edges.join(smallest, "a")
    if large:
        tied = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.select("a", F.col("m").alias("b")))
    return tied.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has two columns of one number type. Rows (node, root): the smallest node each linked node can reach.

    Nodes without an edge to another node are left out; null ends and loops are no edges. Every round is written to the shared
    folder, and only a count and a checksum come to the driver.
    """
    a, b = edges.columns
    edges = settle(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    before = None
    while True:
        edges = settle(_toward_smallest(_toward_smallest(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
