"""Sampling, splitting and batching.

Library shuffles (a seeded permutation) cannot be reproduced across
engines, so order and membership come from ``md5(seed ':' id)``: the
same in Spark and SQL, independent of partitioning, and computable per
row without a shuffle.  Split sizes follow the fractions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.ranking import global_rank


def seed_hash(id_col: str | Column, seed: int = 42) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string")))


def hex_threshold(frac: float, width: int = 8) -> str:
    """Hex string t such that a uniform ``width``-hex prefix is < t with prob. frac."""
    v = min(max(int(round(frac * 16 ** width)), 0), 16 ** width)
    return "g" * width if v >= 16 ** width else format(v, f"0{width}x")


def split_two_way(df: DataFrame, id_col: str, test_fraction: float = 0.1, seed: int = 42,
                  names: tuple[str, str] = ("train", "validation")) -> DataFrame:
    """D3: hold out ``test_fraction`` of rows by hash threshold (no shuffle)."""
    prefix = F.substring(seed_hash(id_col, seed), 1, 8)
    return df.withColumn("split", F.when(prefix < F.lit(hex_threshold(test_fraction)),
                                         F.lit(names[1])).otherwise(F.lit(names[0])))


def split_three_way(df: DataFrame, id_col: str, train: float = 0.8, val: float = 0.1,
                    test: float = 0.1, seed: int = 42) -> DataFrame:
    """Hold out ``1 - train``, divide the holdout by the val:test ratio."""
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError("split fractions must sum to 1")
    holdout = 1.0 - train
    prefix = F.substring(seed_hash(id_col, seed), 1, 8)
    t_hold = F.lit(hex_threshold(holdout))
    t_val = F.lit(hex_threshold(holdout * val / (val + test)))
    return df.withColumn("split", F.when(prefix < t_val, F.lit("validation"))
                         .when(prefix < t_hold, F.lit("test")).otherwise(F.lit("train")))


def split_exact(df: DataFrame, id_col: str, test_fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Exactly ``ceil(frac * n)`` rows to 'test': the first ones in hash order.

    No global sort: a histogram over the first four hex digits (at most
    65,536 buckets, a bounded result) finds the boundary bucket; only the
    rows of that bucket (~n/65,536 of them) are ranked.
    """
    h = df.withColumn("_h", F.substring(seed_hash(id_col, seed), 1, 16)) \
          .withColumn("_b", F.substring("_h", 1, 4))
    hist = sorted((r["_b"], r["n"]) for r in h.groupBy("_b").agg(F.count("*").alias("n")).collect())
    n = sum(c for _, c in hist)
    n_test = math.ceil(test_fraction * n)
    cum, b_star, need = 0, None, 0
    for b, c in hist:
        if cum + c >= n_test:
            b_star, need = b, n_test - cum
            break
        cum += c
    if b_star is None or n_test == 0:
        return h.withColumn("split", F.lit("train")).drop("_h", "_b")
    outside = h.filter(F.col("_b") != b_star).withColumn(
        "split", F.when(F.col("_b") < b_star, F.lit("test")).otherwise(F.lit("train")))
    w = Window.partitionBy("_b").orderBy("_h", id_col)
    inside = h.filter(F.col("_b") == b_star).withColumn(
        "split", F.when(F.row_number().over(w) <= need, F.lit("test")).otherwise(F.lit("train")))
    return outside.unionByName(inside).drop("_h", "_b")


def split_if_missing(df: DataFrame, id_col: str, val_fraction: float = 0.02,
                     test_fraction: float = 0.02, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """If validation or test is absent, carve both from train (others dropped)."""
    def present(name: str) -> bool:
        return len(df.filter(F.col(split_col) == name).select(split_col).limit(1).collect()) > 0

    if not present("train"):
        raise ValueError("train split not found")
    if present("validation") and present("test"):
        return df
    train = df.filter(F.col(split_col) == "train").drop(split_col)
    return split_three_way(train, id_col, 1.0 - val_fraction - test_fraction,
                           val_fraction, test_fraction, seed)


def head_sample(df: DataFrame, order_col: str, n: int, accuracy: int = 10000) -> DataFrame:
    """The first ``n`` rows by ``order_col`` (all rows if fewer).

    Rows with a NULL order value come last.  No global sort and no
    single-task TakeOrdered (the reference's ``n`` is 1,000,000): an
    approximate quantile gives a cutoff whose rank error is at most
    ``count / accuracy``; the cutoff is checked with an exact count and
    raised while it is short, at the latest to the largest value; only the
    rows at or below it are ranked.
    """
    total, known = df.agg(F.count("*"), F.count(order_col)).first()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    if n > known:  # every row with a value, and the rest from those without
        rest = global_rank(df.filter(F.col(order_col).isNull()), [F.xxhash64(*df.columns)], rank_col="_r")
        return df.filter(F.col(order_col).isNotNull()).unionByName(
            rest.filter(F.col("_r") < n - known).drop("_r"))
    q = n / known
    while True:
        cut = F.max(order_col) if q >= 1.0 else F.percentile_approx(order_col, q, accuracy)
        t = df.agg(cut).first()[0]
        if df.filter(F.col(order_col) <= t).count() >= n:
            break
        q = 1.01 * q + 1.0 / accuracy
    cand = df.filter(F.col(order_col) <= t)
    return global_rank(cand, [order_col], rank_col="_r").filter(F.col("_r") < n).drop("_r")


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """A seeded, engine-independent permutation; adds ``shuffle_pos``."""
    h = df.withColumn("_h", seed_hash(id_col, seed))
    return global_rank(h, ["_h", id_col], rank_col="shuffle_pos").drop("_h")


def batch_assign(df: DataFrame, id_col: str, batch_size: int, seed: int = 42,
                 split_col: str = "split", shuffled: tuple[str, ...] = ("train",)) -> DataFrame:
    """Fixed-size batches per split; shuffled splits in hash order, others by id.

    The last batch of a split may be partial.
    """
    key = F.when(F.col(split_col).isin(*shuffled), seed_hash(id_col, seed)).otherwise(F.lit(""))
    ranked = global_rank(df.withColumn("_k", key), ["_k", id_col], groups=[split_col],
                         rank_col="position")
    return ranked.withColumn("batch", (F.col("position") / batch_size).cast("long")).drop("_k")


def grad_accum_steps(log: DataFrame, accum: int = 16) -> DataFrame:
    """Optimizer steps under gradient accumulation, per (run, epoch).

    A step happens every ``accum`` micro-batches; trailing micro-batches of
    an epoch never step, yet the planned count ``ceil(micro / accum)``
    includes them.  ``global_step_end`` is the running step count.
    """
    per_epoch = log.groupBy("run_id", "epoch").agg(F.count("*").alias("micro_batches"))
    w = Window.partitionBy("run_id").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    taken = F.floor(F.col("micro_batches") / accum).cast("long")
    return per_epoch.select(
        "run_id", "epoch", "micro_batches",
        taken.alias("steps_taken"),
        (F.col("micro_batches") % accum).alias("trailing_micro"),
        F.ceil(F.col("micro_batches") / accum).cast("long").alias("planned_steps"),
        F.sum(taken).over(w).alias("global_step_end"),
        F.sum(F.ceil(F.col("micro_batches") / accum).cast("long")).over(w).alias("planned_step_end"))
