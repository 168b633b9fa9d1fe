"""Connected groups of a table of links, without gathering any group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.batches import settled, tidy


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """Groups of nodes joined by links: node, component (the smallest node of the group).

    links: pairs in columns a and b in either order, repeats and loops allowed, nulls ignored. Only nodes of groups of
    two or more are returned. Rounds of large and small stars (every node hooks its greater, then its smaller neighbours
    to the least one) go on until nothing changes; they are few even for long chains. Minima are partially
    aggregated and hubs are only ever joined, so Spark can split a hub's rows.
    """
    up, down = F.greatest(a, b), F.least(a, b)
    edges = settled(links.where(F.col(a) != F.col(b)).select(up.alias("hi"), down.alias("lo")).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if not now[0] or now == before:
            break
        before = now
        tidy(links.sparkSession)
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
        large = both.join(least, "hi").where(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = settled(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
