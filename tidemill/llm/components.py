"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.storage import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Alternating large and small stars: every node hands its smallest neighbour to the larger, then
    to the smaller ones, until only stars around the smallest nodes are left. The number of rounds
    grows with the logarithm of the longest chain. Minima are combined before each shuffle, and a
    hub's links are an ordinary join, so that its rows can be split. Each round is written.
    """
    stars = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    before = None
    while True:
        # every node's larger neighbours go to its smallest neighbour
        both = stars.union(stars.selectExpr("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "large-stars")
        # every node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        stars = materialize(small, "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    members = stars.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
