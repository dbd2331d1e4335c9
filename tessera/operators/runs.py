"""Training-log analytics and the run ledger.

Windows are always partitioned by run: one run's epochs are bounded by
its training schedule, never by data volume.  Input ``epoch_log`` has
``(run_id, epoch, train_loss, val_loss, val_f1, seconds, ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Checkpoint file-name patterns.
BEST_FILE = "model_best_epoch{}.pt"
EPOCH_FILE = "model_epoch{}.pt"


def _run_w(order: str = "epoch") -> Window:
    return Window.partitionBy("run_id").orderBy(order)


def best_epoch_flags(log: DataFrame, metric: str = "val_f1") -> DataFrame:
    """New best when the metric is strictly above every earlier epoch (start 0.0)."""
    prev = F.max(metric).over(_run_w().rowsBetween(Window.unboundedPreceding, -1))
    return log.withColumn("is_best", F.col(metric) > F.coalesce(prev, F.lit(0.0)))


def early_stop(log: DataFrame, patience: int = 3, min_delta: float = 0.0,
               metric: str = "val_loss") -> DataFrame:
    """Early stopping as a fold over each run's epochs.

    The best resets only when ``best - value > min_delta``; otherwise
    patience drops and training stops when it reaches 0.  A running min
    would be wrong for ``min_delta > 0`` (small gains accumulate).  The
    per-run list holds one entry per epoch.
    """
    per_run = log.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("epoch").alias("e"),
                                             F.col(metric).cast("double").alias("v")))).alias("h"),
        F.max("epoch").alias("last_epoch"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(None).cast("int").alias("best_epoch"),
                    F.lit(patience).alias("left"), F.lit(None).cast("int").alias("stopped"))

    def step(s: Column, x: Column) -> Column:
        improve = (s["best"] - x["v"]) > F.lit(min_delta)
        left = s["left"] - 1
        return F.when(s["stopped"].isNotNull(), s).when(
            improve, F.struct(x["v"].alias("best"), x["e"].alias("best_epoch"),
                              F.lit(patience).alias("left"), F.lit(None).cast("int").alias("stopped"))
        ).otherwise(F.struct(s["best"].alias("best"), s["best_epoch"].alias("best_epoch"),
                             left.alias("left"),
                             F.when(left == 0, x["e"]).otherwise(F.lit(None).cast("int")).alias("stopped")))

    f = per_run.select("run_id", "last_epoch", F.aggregate("h", init, step).alias("s"))
    return f.select("run_id", F.col("s.stopped").alias("stopped_epoch"),
                    F.col("s.best_epoch").alias("best_epoch"), F.col("s.best").alias("best_value"),
                    F.coalesce(F.col("s.stopped"), F.col("last_epoch")).alias("epochs_run"))


def save_points(log: DataFrame, save_every: int = 3) -> DataFrame:
    """Periodic save flag: ``epoch % save_every == 0`` or the last epoch."""
    last = F.max("epoch").over(Window.partitionBy("run_id"))
    return log.withColumn("periodic", (F.col("epoch") % save_every == 0) | (F.col("epoch") == last))


def step_points(train_log: DataFrame, save_steps: int, logging_steps: int) -> DataFrame:
    """W3 (steps): save / log points among the run's global steps, per epoch."""
    return train_log.groupBy("run_id", "epoch").agg(
        F.sum(F.when(F.col("step") % save_steps == 0, 1).otherwise(0)).cast("long").alias("save_points"),
        F.sum(F.when(F.col("step") % logging_steps == 0, 1).otherwise(0)).cast("long").alias("log_points"))


def epoch_time_mean(log: DataFrame) -> DataFrame:
    """Mean epoch time of the *earlier* epochs (interim saves lag by one)."""
    prev = F.avg("seconds").over(_run_w().rowsBetween(Window.unboundedPreceding, -1))
    return log.withColumn("mean_epoch_seconds", prev)


def total_time(log: DataFrame) -> DataFrame:
    """Per run total time, latest epoch time and epoch count."""
    return log.groupBy("run_id").agg(
        F.sum("seconds").alias("total_seconds"),
        F.max_by("seconds", "epoch").alias("latest_epoch_seconds"),
        F.count("*").alias("epochs"))


def pick_checkpoint(flags: DataFrame) -> DataFrame:
    """Last best checkpoint, else last periodic one; numeric and
    lexicographic (reference parity: ``epoch9`` after ``epoch10``) orders.

    ``flags`` has ``(run_id, epoch, is_best, periodic)``.
    """
    best_name = F.format_string(BEST_FILE.replace("{}", "%d"), F.col("epoch"))
    epoch_name = F.format_string(EPOCH_FILE.replace("{}", "%d"), F.col("epoch"))
    g = flags.groupBy("run_id").agg(
        F.max(F.when(F.col("is_best"), F.col("epoch"))).alias("best_e"),
        F.max(F.when(F.col("periodic"), F.col("epoch"))).alias("per_e"),
        F.max(F.when(F.col("is_best"), best_name)).alias("best_lex"),
        F.max(F.when(F.col("periodic"), epoch_name)).alias("per_lex"))
    numeric = F.when(F.col("best_e").isNotNull(),
                     F.format_string(BEST_FILE.replace("{}", "%d"), F.col("best_e"))) \
        .otherwise(F.format_string(EPOCH_FILE.replace("{}", "%d"), F.col("per_e")))
    picked = g.select("run_id", numeric.alias("ckpt_numeric"),
                      F.coalesce("best_lex", "per_lex").alias("ckpt_lexicographic"))
    return picked.withColumn("ckpt_numeric", F.when(
        F.col("ckpt_lexicographic").isNull(),
        F.raise_error(F.lit("no checkpoint files for a run"))).otherwise(F.col("ckpt_numeric")))


def loss_curve(train_log: DataFrame, phase: Column) -> DataFrame:
    """Loss per (run, epoch) with one column per phase (pivot)."""
    return train_log.withColumn("phase", phase).groupBy("run_id", "epoch") \
        .pivot("phase", ["training", "validation"]).agg(F.avg("loss"))


def run_compare(per_run: DataFrame, group: str, metrics: list[str], groups: list[str]) -> DataFrame:
    """Metric rows x run-group columns (mean over the group's runs).

    Pivot values are given, so Spark does not scan for distinct groups.
    """
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                for m in metrics]))
    long = per_run.select(group, stack.alias("kv")).select(group, "kv.metric", "kv.value")
    return long.groupBy("metric").pivot(group, groups).agg(F.avg("value"))
