"""Resampled confidence bounds of a mean.

Drawing n rows with replacement gives a row a number of copies that is
nearly Poisson with mean 1, independently of the others.  So every row
draws its own copies in every replicate, from a hash of its key: one pass,
no rows moved, the same draws in any engine and under any partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A 16-bit draw u is k copies if it is under k of these and not under k - 1 ...
_CUM = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(8)]
THRESHOLDS = [round(65536 * c) for c in _CUM]
#: Replicates that one md5 serves: eight draws of 16 bits.
PER_HASH = 8


def draws(key: Column, hash_number: Column, seed: int) -> Column:
    """Eight numbers of copies from md5(seed:key:number)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), hash_number.cast("string")))
    parts = [F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("int") for i in range(PER_HASH)]
    return F.array(*[sum([F.when(u >= t, 1).otherwise(0) for t in THRESHOLDS[1:]], F.when(u >= THRESHOLDS[0], 1).otherwise(0)) for u in parts])


def replicate_means(rows: DataFrame, key: str, values: list[str], replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(replicate, one mean for each value): means over the resampled rows."""
    hashes = -(-replicates // PER_HASH)
    drawn = rows.select(key, *values, F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("_h"))
    copies = drawn.select(*values, "_h", F.posexplode(draws(F.col(key), F.col("_h"), seed)).alias("_i", "_c")).select(
        (F.col("_h") * PER_HASH + F.col("_i")).alias("replicate"), "_c", *values).where(F.col("replicate") < replicates)
    return copies.groupBy("replicate").agg(*[(F.sum(F.col("_c") * F.col(v)) / F.sum("_c")).alias(v) for v in values])


def interval(rows: DataFrame, key: str, values: list[str], replicates: int = 1000, seed: int = 42,
             confidence: float = 0.95) -> DataFrame:
    """(measure, low, mid, high): the median and the confidence bounds of
    each value's mean over the replicates (at most ``replicates`` rows)."""
    means = replicate_means(rows, key, values, replicates, seed)
    tail = (1 - confidence) / 2
    long = means.select(F.explode(F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).alias("x")) for v in values])).alias("m")).select("m.*")
    q = F.percentile("x", [tail, 0.5, 1 - tail])
    return long.groupBy("measure").agg(q.alias("q")).select("measure", *[F.col("q")[i].alias(n) for i, n in enumerate(("low", "mid", "high"))])
