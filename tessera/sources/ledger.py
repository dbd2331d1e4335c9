"""Run ledger: training-run metadata as JSON records.

Two layouts, both read by ``read_ledger`` with an explicit schema (no
inference pass over the files): ``write_ledger`` appends to a folder
partitioned by model, where the latest record per run wins on reading;
``save_ledger`` keeps one record a run, which a later save replaces, in a
bounded number of files a model.  The folder must be shared storage on a cluster; ``ledger_dir`` derives it from
the session's checkpoint folder when the caller gives none.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

#: Partitions of a model's runs in a folder of ``save_ledger``.
BUCKETS = 32

# Language-model metrics, then the classifier's; a record fills what applies.
METRIC_NAMES = ("loss", "perplexity", "token_accuracy", "bits_per_token", "tokens_per_second",
                "accuracy", "precision", "recall", "f1")
_METRICS = T.StructType([T.StructField(n, T.DoubleType()) for n in METRIC_NAMES])
_STRINGS = T.MapType(T.StringType(), T.StringType())

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("global_step", T.LongType()),
    T.StructField("config", T.MapType(T.StringType(), T.StringType())),
    T.StructField("params", T.StructType([
        T.StructField("total", T.LongType()), T.StructField("trainable", T.LongType()),
        T.StructField("trainable_pct", T.DoubleType())])),
    T.StructField("train", _METRICS),
    T.StructField("validation", _METRICS),
    T.StructField("test", _METRICS),
    T.StructField("times", T.StructType([
        T.StructField("epoch_seconds", T.DoubleType()), T.StructField("total_seconds", T.DoubleType())])),
    # translation runs: metrics of the generated text and the splits used
    T.StructField("eval_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("splits", _STRINGS),
    T.StructField("resources", _STRINGS),
    T.StructField("artifacts", _STRINGS),
])


def ledger_dir(spark: SparkSession, name: str | None = None) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledger-{name or uuid.uuid4().hex}"


def metrics_struct(**metrics: Column) -> Column:
    """A metrics record; names that are not given are NULL."""
    unknown = set(metrics) - set(METRIC_NAMES)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    return F.struct(*[metrics.get(n, F.lit(None)).cast("double").alias(n) for n in METRIC_NAMES])


def complete(records: DataFrame) -> DataFrame:
    """The columns of the record schema in order; absent ones are NULL."""
    have = set(records.columns)
    return records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                            else F.lit(None).cast(f.dataType).alias(f.name) for f in RUN_RECORD_SCHEMA.fields])


def stamp_compact(ts: str | Column) -> Column:
    """Folder stamp of a run: ``20250131_235959`` (session time zone)."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def stamp_utc(ts: str | Column) -> Column:
    """Record stamp: ISO 8601 in UTC with microseconds."""
    c = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")
    return F.concat(F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def params_struct(total: Column, trainable: Column) -> Column:
    """Parameter counts with the trainable share ``100 * trainable / max(1, total)``."""
    return F.struct(total.cast("long").alias("total"), trainable.cast("long").alias("trainable"),
                    (F.lit(100.0) * trainable / F.greatest(total, F.lit(1))).alias("trainable_pct"))


def write_ledger(records: DataFrame, path: str, mode: str = "append") -> None:
    """Append records as JSON, partitioned by model."""
    complete(records).write.mode(mode).partitionBy("model").json(path)


def save_ledger(records: DataFrame, path: str) -> None:
    """Every run of ``records`` has one record afterwards, its latest of
    these; runs that are not among them keep theirs.

    Runs are dealt to ``BUCKETS`` partitions a model by the hash of their
    number.  Only the partitions of the runs written are replaced, by what
    they held of other runs and the new records together, so the number of
    files does not grow with the runs.  The replacement is checkpointed
    before anything is replaced; a save that fails leaves the old records."""
    spark = records.sparkSession
    ensure_checkpoint_dir(spark)
    bucket = F.pmod(F.xxhash64("run_id"), F.lit(BUCKETS)).cast("int")
    latest = latest_per_run(complete(records)).withColumn("bucket", bucket).checkpoint()
    try:
        old = spark.read.schema(T.StructType([*RUN_RECORD_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])).json(path)
    except AnalysisException:  # nothing saved there yet
        old = None
    if old is not None:
        same = lambda *columns: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
        new = latest.select(*[F.col(c).alias(f"_{c}") for c in ("model", "run_id", "bucket")])
        touched = new.select("_model", "_bucket").distinct()
        kept = old.join(F.broadcast(touched), same("model", "bucket"), "left_semi").join(new, same("model", "run_id"), "left_anti")
        latest = latest.unionByName(kept).checkpoint()
    latest.repartition("model", "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("model", "bucket").json(path)


def compact_ledger(spark: SparkSession, source: str, target: str) -> None:
    """An appended ledger as a new folder with one record a run."""
    save_ledger(read_ledger(spark, source), target)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """S3: read records back with the fixed schema; error when the folder
    holds no record or a record lacks its config."""
    try:
        df = spark.read.schema(RUN_RECORD_SCHEMA).json(path).select(*RUN_RECORD_SCHEMA.names)
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(f"no run records under {path}") from e
    probe = df.agg(F.count("*").alias("n"), F.sum(F.when(F.col("config").isNull(), 1).otherwise(0)).alias("nc"))
    n, nc = probe.first()
    if not n:
        raise FileNotFoundError(f"no run records under {path}")
    if nc:
        raise LookupError("config not found in run record")
    return df


def latest_per_run(records: DataFrame) -> DataFrame:
    """The last record of each run (highest epoch, then step, then time)."""
    order = F.struct("epoch", "global_step", "timestamp")
    latest = records.groupBy("model", "run_id").agg(F.max_by(F.struct(*records.columns), order).alias("r"))
    return latest.select("r.*")
