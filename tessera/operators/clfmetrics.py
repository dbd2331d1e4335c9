"""Classification and language-model metrics.

All are distributed aggregations: conditional sums with map-side partial
aggregation; division guarded with ``try_divide`` (ANSI mode is on).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def clf_metrics(df: DataFrame, gold: str = "gold", pred: str = "pred",
                by: list[str] | None = None) -> DataFrame:
    """A1: accuracy, precision, recall, F1 for class 1; zero denominator -> 0."""
    by = by or []
    g, p = F.col(gold), F.col(pred)
    agg = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.when(g == p, 1).otherwise(0)).cast("long").alias("correct"),
        F.sum(F.when((g == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((g == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((g == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("fn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(
        *by, "n", "tp", "fp", "fn",
        _safe_div(F.col("correct"), F.col("n")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def loss_mean_of_batches(log: DataFrame, batch_size: int = 4) -> DataFrame:
    """A2: epoch loss as the unweighted mean of per-batch mean losses.

    Batches are consecutive ``batch_size`` micro-rows of the epoch.
    """
    b = log.withColumn("batch", ((F.col("micro") - 1) / batch_size).cast("int"))
    per_batch = b.groupBy("run_id", "epoch", "batch").agg(F.avg("loss").alias("batch_loss"))
    return per_batch.groupBy("run_id", "epoch").agg(
        F.avg("batch_loss").alias("epoch_loss"), F.count("*").alias("n_batches"))


def loss_token_weighted(log: DataFrame) -> DataFrame:
    """A3: sum(loss * tokens) / max(1, sum(tokens)) per (run, epoch)."""
    return log.groupBy("run_id", "epoch").agg(
        (F.sum(F.col("loss") * F.col("tokens")) / F.greatest(F.sum("tokens"), F.lit(1)))
        .alias("epoch_loss"),
        F.sum("tokens").cast("long").alias("tokens"))


def log_softmax_parts(v: Column) -> tuple[Column, Column]:
    """(max, logsumexp) of a numeric array, max-subtracted for stability."""
    mx = F.array_max(v)
    lse = mx + F.log(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.exp(x - mx)))
    return mx, lse


def softmax_argmax(df: DataFrame, vec: str = "logits") -> DataFrame:
    """M4: argmax (first on ties), max probability and logsumexp per row."""
    v = F.col(vec)
    mx, lse = log_softmax_parts(v)
    return df.select(
        "*", (F.array_position(v, mx) - 1).cast("int").alias("argmax"),
        F.exp(mx - lse).alias("max_prob"), lse.alias("logsumexp"))


def cross_entropy(df: DataFrame, vec: str = "logits", gold: str = "gold",
                  ignore_index: int | None = 0) -> DataFrame:
    """A4: per-row cross-entropy ``logsumexp - logit[gold]``; ignored rows removed."""
    v = F.col(vec)
    _, lse = log_softmax_parts(v)
    kept = df if ignore_index is None else df.filter(F.col(gold) != ignore_index)
    return kept.select("*", (lse - F.element_at(v, F.col(gold) + 1)).alias("ce"))


def lm_metrics(mean_loss: Column) -> list[Column]:
    """A5: perplexity (inf from loss 20 on) and bits per token."""
    return [F.when(mean_loss < 20, F.exp(mean_loss)).otherwise(F.lit(float("inf"))).alias("perplexity"),
            (mean_loss / F.lit(math.log(2.0))).alias("bits_per_token")]


def token_accuracy(df: DataFrame, seq: str, pos: str, pred: str, gold: str,
                   shift: int = 1, ignore_index: int | None = 0) -> DataFrame:
    """Share of non-ignored positions whose prediction equals the label.

    ``shift=1`` compares the prediction at position p with the label at
    p+1 (causal LM); ``shift=0`` is the reference's unshifted comparison.
    """
    w = Window.partitionBy(seq).orderBy(pos)
    lbl = F.col(gold) if shift == 0 else F.lead(gold, shift).over(w)
    t = df.select(F.col(pred).alias("p"), lbl.alias("l"))
    t = t.filter(F.col("l").isNotNull())
    if ignore_index is not None:
        t = t.filter(F.col("l") != ignore_index)
    return t.agg(F.sum(F.when(F.col("p") == F.col("l"), 1).otherwise(0)).cast("long").alias("correct"),
                 F.count("*").alias("total")).select(
        F.lit(shift).alias("shift"), "correct", "total",
        (F.col("correct") / F.greatest(F.col("total"), F.lit(1))).alias("token_accuracy"))


def tokens_per_second(tokens: Column, seconds: Column) -> Column:
    """Throughput with the elapsed time floored at 1e-9 s."""
    return tokens / F.greatest(seconds, F.lit(1e-9))
