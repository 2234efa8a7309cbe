"""Connected components of a graph of documents, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobscape.sinks.tables import settle


def connected(edges: DataFrame) -> DataFrame:
    """``doc`` and ``component`` (its smallest reachable document) of every document in ``edges`` (a, b).

    A round links all larger neighbours of each document to its smallest neighbour, then all smaller neighbours
    likewise, until nothing changes; so a chain halves with each round. Every round is written to the shared folder,
    which cuts the lineage; only two numbers reach the driver. A document with very many neighbours is a hot key of
    plain joins, which adaptive execution splits, and of a minimum taken on the map side.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = settle(pairs, "edges")
    while not _are_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges now end in centres: a document has few of them as its larger end.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        pairs = settle(small.filter("u <> v").distinct(), "stars")
    roots = pairs.select(F.col("u").alias("doc"), F.col("v").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("doc"), "component").distinct())


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    larger = pairs.select(F.col("u").alias("end"), F.lit(1).alias("larger"), F.lit(0).alias("smaller"))
    smaller = pairs.select(F.col("v").alias("end"), F.lit(0).alias("larger"), F.lit(1).alias("smaller"))
    ends = larger.unionByName(smaller).groupBy("end").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return ends.filter(F.col("larger") + F.col("smaller") * F.signum("larger") > 1).isEmpty()
