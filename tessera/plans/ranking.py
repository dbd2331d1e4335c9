"""Distributed positional primitives.

``global_rank`` gives a gap-free 0-based rank in any total order without
pulling rows into one task: a range-partitioned sort that is written to
the shared checkpoint folder, then per-partition row offsets (one small
aggregate of partitions x groups rows) added to the in-partition
position.  The offsets are taken from the written rows, so a lost
executor cannot make a second sort disagree with them.

``grouped_rank`` numbers rows inside groups of any size and skew: a
``bucket`` that never decreases in the order cuts each group into short
runs; rows are numbered inside (group, bucket) and the counts of the
group's earlier buckets are added.

``Window.orderBy`` over whole groups would move a hot group (or, without
``partitionBy``, every row) through a single task instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def cluster(df: DataFrame, key: str | Column) -> DataFrame:
    """Hash-cluster rows by ``key`` into ``spark.sql.shuffle.partitions``
    parts.  The explicit count keeps AQE from coalescing a small input
    (e.g. pair rows) into one task right before a large per-row expansion;
    groupings that start with ``key`` then need no further exchange."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def global_rank(df: DataFrame, order: list[str | Column], groups: list[str] | None = None,
                rank_col: str = "rank") -> DataFrame:
    """Add ``rank_col``: 0-based position in ``order`` within each group.

    ``order`` must be a total order (end it with a unique id).  ``groups``
    must be low-cardinality (splits, not entities): the offset table has
    one row per (sort partition, group) and is broadcast on that bound.
    NULL is a group like any other.
    """
    ensure_checkpoint_dir(df.sparkSession)
    groups = list(groups or [])
    keys = [F.col(g) for g in groups] + [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = (df.orderBy(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mono", F.monotonically_increasing_id())
              .checkpoint())
    seg = tagged.groupBy("_pid", *groups).agg(F.count("*").alias("_n"),
                                               F.min("_mono").alias("_m0"))
    w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_m0",
                     F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)],
                F.col("_pid") == F.col("_p"))
    out = tagged.join(F.broadcast(seg), on)
    return out.withColumn(rank_col, F.col("_off") + F.col("_mono") - F.col("_m0")).select(
        *df.columns, rank_col)


def grouped_rank(df: DataFrame, groups: list[str], order: list[str], bucket: Column,
                 rank_col: str = "rank") -> DataFrame:
    """0-based position in ``order`` within each group (``row_number() - 1``)
    without a task per group.  ``bucket`` must not decrease along ``order``
    (e.g. the minute of a leading time stamp) and should be fine enough for
    the rows of one (group, bucket) to fit a task.  ``order`` must make the
    order total; a NULL group is a group like any other."""
    tagged = df.withColumn("_b", bucket)
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = tagged.groupBy(*groups, "_b").agg(F.count("*").alias("_n")).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_b").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)],
                F.col("_b").eqNullSafe(F.col("_c")))
    within = Window.partitionBy(*groups, "_b").orderBy(*order)
    ranked = tagged.withColumn("_r", F.row_number().over(within) - 1).join(counts, on)
    return ranked.select(*df.columns, (F.col("_off") + F.col("_r")).cast("long").alias(rank_col))
