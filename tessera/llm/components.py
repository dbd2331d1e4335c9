"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: longs); the root is
    the smallest node of its component.

    Alternating stars: each node points its larger neighbours at its
    smallest one, then its smaller ones; the number of links never grows
    and every component becomes a star around its smallest node after a
    number of rounds that grows with the logarithm of its diameter.  Each
    round is written to the shared folder."""
    pair = F.col("u") != F.col("v")
    edges = written(edges.select("u", "v").where(pair).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("k")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(pair).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = down.join(least, F.col("u") == F.col("k"))
        edges = written(small.select("u", F.col("m").alias("v")).union(small.select("v", "m")).where(pair).distinct(), "links")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
