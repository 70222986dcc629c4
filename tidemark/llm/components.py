"""Connected components of an edge table by joins: no graph reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, written


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node and component (the least node it reaches) for each node of an edge.

    Rounds of large-star and small-star: each node's larger neighbours, then its smaller ones, are
    tied to the least node around it, until every edge points at its component's least node. The
    number of rounds grows with the logarithm of the longest path. Null ends are left out; loops and
    repeated edges are allowed; no edges give no rows. Each round is written, so lineage stays
    short, and the table of the round before removed.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).dropna().distinct()
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    e = e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = last = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours go to the least of the node and its neighbours
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = written(e, "stars")
        if last is not None:
            dropped(last)
        last = e
        # stable when a round changes nothing: same rows, by count and an order-free sum of hashes
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = e.groupBy("u").agg(F.min("v").alias("m"))
    return nodes.join(found, nodes["node"] == found["u"], "left").select("node", F.coalesce("m", "node").alias("component"))
