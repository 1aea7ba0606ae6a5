"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialize


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    inner = e.join(least, F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that an edge joins to a smaller one; root is the component's smallest node.

    Roots themselves and isolated nodes have no row.  Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the component sizes.  A hub with very many edges is only aggregated (with partial
    sums) and joined, never gathered.
    """
    x, y = F.col(a), F.col(b)
    e = materialize(edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    seen = _fingerprint(e)
    while True:
        e = materialize(_small_star(_large_star(e)), "edges")
        now = _fingerprint(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
