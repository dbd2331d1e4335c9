"""Exact all-pairs work inside groups, in bounded blocks.

Some metrics compare every member of a group with every other (greedy
embedding matching, softmax lookups).  Rather than emitting one row per
pair, each group is cut into hash blocks of at most ~``block`` rows per
side; a cell ``(group, left block, right block)`` meets one left block
with one right block in an Arrow batch, and numpy does the block's
matrix work.  Per-row partial results are merged afterwards by an
ordinary aggregation.  A group holding a third of all rows becomes many
cells of bounded size, so no task ever holds a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package


def block_cells(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str,
                block: int = 1024) -> tuple[DataFrame, DataFrame]:
    """Tag rows with ``(_lb, _rb)`` cells; left rows are copied to every
    right block of their group and vice versa.  The right side's group
    column is renamed ``_rgrp`` (both sides often come from one table)."""
    right = right.withColumnRenamed(group, "_rgrp")
    sides = left.select(F.col(group).alias("_g"), F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(F.col("_rgrp").alias("_g"), F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    nb = sides.groupBy("_g").agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr")).filter(
        (F.col("_nl") > 0) & (F.col("_nr") > 0)).select(
        "_g", F.ceil(F.col("_nl") / block).cast("int").alias("_lnb"),
        F.ceil(F.col("_nr") / block).cast("int").alias("_rnb"))
    lt = left.join(nb, F.col(group) == F.col("_g")).drop("_g") \
        .withColumn("_lb", F.pmod(F.xxhash64(left_id), F.col("_lnb")).cast("int")) \
        .withColumn("_rb", F.explode(F.sequence(F.lit(0), F.col("_rnb") - 1))).drop("_lnb", "_rnb")
    nb2 = nb.select(F.col("_g").alias("_g2"), "_lnb", "_rnb")
    rt = right.join(nb2, F.col("_rgrp") == F.col("_g2")).drop("_g2") \
        .withColumn("_rb", F.pmod(F.xxhash64(right_id), F.col("_rnb")).cast("int")) \
        .withColumn("_lb", F.explode(F.sequence(F.lit(0), F.col("_lnb") - 1))).drop("_lnb", "_rnb")
    return lt, rt


def cogroup_cells(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str,
                  fn, schema: str, block: int = 1024) -> DataFrame:
    """Run ``fn(left_pdf, right_pdf) -> pdf`` once per non-empty cell."""
    ship_package(left.sparkSession)
    lt, rt = block_cells(left, right, group, left_id, right_id, block)
    return lt.groupBy(group, "_lb", "_rb").cogroup(rt.groupBy("_rgrp", "_lb", "_rb")) \
        .applyInPandas(fn, schema)
