"""Mixing sources to target weights by systematic sampling.

Every document expects target / source size copies.  Within a source the
documents stand in a fixed order, near-sorted by size; the expected
copies are prefix-summed, one random offset is added, and a document is
emitted once per integer boundary that its interval crosses.  So each
document gets the whole part of its expectation or one more, and since
neighbours in the order are of like size, the words taken stay within
about one large document of the target.

The prefix sum runs over groups (source, size class, id bucket): group
totals are small and summed first, then each group is summed on its own,
so a source of any size is spread over many tasks.  Sums are fixed-point
integers, so reruns agree bit for bit.

Defined results: null and empty texts have size 0 and take 0 words; the
null source is a source of its own, last in order; sources without words
have target 0; repeated rows are documents of their own; null ids are
allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import n_words

ONE = 1 << 30  # an expected copy in fixed point


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, size): ``share`` of all
    words dealt by weight, no target above ``most`` times its source.

    Dealing the excess anew by weight until no target is above its limit
    ends at one level for which target = min(limit, level * weight); the
    sources fill up in the order of limit / weight, so prefix sums in that
    order give the level.  One row per source runs through these windows,
    however many documents there are."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = (per.withColumn("place", F.row_number().over(by_name) - 1)
           .withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
           .withColumn("ratio", F.col("limit") / F.col("weight")))
    order = Window.orderBy("ratio", "place")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole))
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return per.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The columns ``keep`` of every document plus size, source_size,
    target, copies and taken (copies times size)."""
    id_text = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    # never null, so that the join and the window share one exchange
    source_key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`")), F.lit("n"))
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        F.col(f"`{source}`").alias("source"), source_key.alias("key"), F.col(f"`{doc_id}`").alias("id"), n_words(F.col(f"`{text}`")).alias("size"),
        F.substring(F.md5(id_text.cast("binary")), 1, 2).alias("bucket"))
    rows = rows.withColumn("kind", -F.floor(F.sqrt("size")))
    groups = rows.groupBy("key", "kind", "bucket").agg(F.first("source").alias("source"), F.count("*").alias("n"), F.sum("size").alias("size"))

    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))).cast("binary")), 1, 7), 16, 10).cast("long") * 4
    unit = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE)).otherwise(F.lit(0)).cast("long")
    plan = targets(groups, weights, share, most).withColumn("unit", F.least(unit, F.lit(int(most * ONE)).cast("long")))
    place = Window.partitionBy("key").orderBy("kind", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    null_safe = groups["source"].eqNullSafe(plan["source"])
    starts = (groups.join(plan, null_safe).drop(plan["source"])
              .withColumn("passed", offset + F.coalesce(F.sum((F.col("n") * F.col("unit")) % ONE).over(place), F.lit(0)))
              .select(F.col("key").alias("s"), F.col("kind").alias("c"), F.col("bucket").alias("b"),
                      "source_size", "target", "unit", (F.col("passed") % ONE).alias("passed")))
    on = (rows["key"] == starts["s"]) & (rows["kind"] == starts["c"]) & (rows["bucket"] == starts["b"])
    within = Window.partitionBy("key", "kind", "bucket").orderBy("id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(starts, on).withColumn("upto", F.col("passed") + F.sum("unit").over(within))
    copies = F.floor(F.col("upto") / ONE) - F.floor((F.col("upto") - F.col("unit")) / ONE)
    out = summed.withColumn("copies", copies.cast("long"))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))
