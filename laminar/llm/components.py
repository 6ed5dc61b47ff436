"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import drop, settle


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    Each round connects every node's larger neighbours to its smallest one (large star),
    then its smaller neighbours to the smallest of them (small star); the number of rounds
    grows with the logarithm of the longest path.  Rounds are written to the shared folder,
    so lineage stays short; only a count and a checksum reach the driver.  Minima are
    aggregated map-side, and the joins are plain equi-joins that adaptive execution splits
    when one hub holds many edges.  Nulls and self-loops are ignored; an empty edge table
    gives an empty result.
    """
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = settle(e, "edges")
    seen = _mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        last, e = e, settle(small, "edges")
        drop(last)
        now = _mark(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return r["n"], r["s"]
