"""Queries: run-ledger round trip (S2, S3, W8) and per-row operators on a
stream (T1, C1-C3 over a file source)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.text import WORD, word_tokens
from tessera.operators import answers as ans
from tessera.plans import fixtures as fx
from tessera.plans.q_answers import LLM_SQL, gold_sql
from tessera.plans.q_classify import SQL_SPLIT_DS, split_dataset
from tessera.plans.registry import r6, register
from tessera.session import ensure_checkpoint_dir
from tessera.sources import ledger, splits
from tessera.streaming.rowwise import read_table_stream, run_available

FAMILIES = ["bert", "bilstm", "lr"]


def ledger_records(spark, sf_dir):
    """W8 nested records, one per (run, epoch), test metrics NULL."""
    e = fx.epoch_log(spark, sf_dir)
    w = Window.partitionBy("run_id").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    fam = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.col("run_id") % 3 + 1).cast("int"))
    total = F.sum("n_batches").over(Window.partitionBy("run_id")).cast("long")
    return e.select(
        fam.alias("model"), "run_id", ledger.stamp_utc("last_ts").alias("timestamp"),
        F.col("epoch").cast("int").alias("epoch"), F.sum("n_batches").over(w).cast("long").alias("global_step"),
        F.create_map(F.lit("save_every"), F.lit("3"), F.lit("grad_accum_steps"), F.lit("4")).alias("config"),
        ledger.params_struct(total, F.col("n_batches")).alias("params"),
        ledger.metrics_struct(loss=F.col("train_loss")).alias("train"),
        ledger.metrics_struct(loss=F.col("val_loss"), f1=F.col("val_f1")).alias("validation"),
        F.struct(F.col("seconds").alias("epoch_seconds"),
                 F.sum("seconds").over(w).alias("total_seconds")).alias("times"),
        F.create_map(F.lit("tokens"), F.col("tokens").cast("string")).alias("resources"),
        F.create_map(F.lit("checkpoint"), F.concat(F.lit("run-"), ledger.stamp_compact("last_ts"))).alias("artifacts"))


LEDGER_SQL = fx.with_views("""
WITH r AS (SELECT CASE run_id % 3 WHEN 0 THEN 'bert' WHEN 1 THEN 'bilstm' ELSE 'lr' END AS model, run_id,
                  CAST(epoch AS INTEGER) AS epoch,
                  CAST(sum(n_batches) OVER (PARTITION BY run_id ORDER BY epoch) AS BIGINT) AS global_step,
                  train_loss, val_loss, val_f1, last_ts, tokens, 100.0 * n_batches / sum(n_batches) OVER (PARTITION BY run_id) AS share, sum(seconds) OVER (PARTITION BY run_id ORDER BY epoch) AS total_seconds
           FROM epoch_log)
SELECT model, run_id, epoch, global_step, floor((train_loss) * 1e6 + 0.5) / 1e6 AS train_loss,
       floor((val_loss) * 1e6 + 0.5) / 1e6 AS val_loss, floor((total_seconds) * 1e6 + 0.5) / 1e6 AS total_seconds,
       '{"save_every":"3","grad_accum_steps":"4"}' AS config_json, floor((val_f1) * 1e6 + 0.5) / 1e6 AS val_f1,
       floor((share) * 1e6 + 0.5) / 1e6 AS trainable_pct, strftime(last_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       CAST(tokens AS VARCHAR) AS tokens, 'run-' || strftime(last_ts, '%Y%m%d_%H%M%S') AS checkpoint
FROM r QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC) = 1""", "epoch_log")


@register("run_ledger_roundtrip", LEDGER_SQL)
def q_ledger(spark, sf_dir):
    """S2 + S3: write every epoch's record, read back, keep the latest per run."""
    path = ledger.ledger_dir(spark)
    ledger.write_ledger(ledger_records(spark, sf_dir), path)
    latest = ledger.latest_per_run(ledger.read_ledger(spark, path))
    return latest.select("model", "run_id", "epoch", "global_step", r6("train.loss").alias("train_loss"),
                         r6("validation.loss").alias("val_loss"), r6("times.total_seconds").alias("total_seconds"),
                         F.to_json("config").alias("config_json"), r6("validation.f1").alias("val_f1"),
                         r6("params.trainable_pct").alias("trainable_pct"), "timestamp",
                         F.col("resources")["tokens"].alias("tokens"), F.col("artifacts")["checkpoint"].alias("checkpoint"))


@register("ledger_overwrite", f"SELECT model, run_id, epoch, global_step, val_loss, 1::BIGINT AS n_records FROM ({LEDGER_SQL})")
def q_ledger_overwrite(spark, sf_dir):
    """A save after the first epoch, an appended ledger compacted
    over it, and a save of every run: one record a run is left."""
    records, path = ledger_records(spark, sf_dir), ledger.ledger_dir(spark)
    ledger.save_ledger(records.where("epoch <= 1"), path)
    appended = ledger.ledger_dir(spark)
    ledger.write_ledger(records.where("epoch <= 2"), appended)
    ledger.compact_ledger(spark, appended, path)
    ledger.save_ledger(records, path)
    kept = ledger.read_ledger(spark, path)
    n = F.count("*").over(Window.partitionBy("model", "run_id"))
    return kept.select("model", "run_id", "epoch", "global_step", r6("validation.loss").alias("val_loss"), n.alias("n_records"))


def stream_transform(df):
    """Per-row work that is valid on a stream: tokens, gold answer, model answer."""
    worked = F.concat(F.col("text"), F.lit("\n#### "), F.col("n_chars").cast("string"))
    response = F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>\nAnswer: "),
                        F.col("n_chars").cast("string"))
    t = df.select("doc_id", F.size(word_tokens("text")).alias("n_tokens"),
                  ans.gold_answer(worked).alias("gold"), response.alias("response"))
    return ans.llm_answer(t, "response").drop("response")


STREAM_SQL = ("WITH base AS (SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '(" + WORD + "+)', 1)) AS INTEGER)"
              " AS n_tokens, text || chr(10) || '#### ' || CAST(n_chars AS VARCHAR) AS worked,"
              " '<think>' || text || '</think>' || chr(10) || 'Answer: ' || CAST(n_chars AS VARCHAR)"
              " AS response FROM documents),\n" + LLM_SQL.replace("FROM responses", "FROM base") +
              "\nSELECT b.doc_id, b.n_tokens, " + gold_sql("b.worked") + " AS gold, model_ans.llm_answer"
              " FROM base b JOIN model_ans USING (doc_id)")


@register("stream_rowwise", STREAM_SQL)
def q_stream_rowwise(spark, sf_dir):
    """T1 + C1-C3 over ``documents`` read as a file stream."""
    return run_available(spark, read_table_stream(spark, sf_dir, "documents"), stream_transform)


@register("split_dataset_roundtrip", fx.with_views("WITH " + SQL_SPLIT_DS.strip() + """
SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM ds GROUP BY split""", "labelled_text"))
def q_split_roundtrip(spark, sf_dir):
    """A dataset with named splits written to a folder partitioned by
    split and read back from there."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/splits-{uuid.uuid4().hex}"
    splits.write_split_dataset(split_dataset(spark, sf_dir).select("doc_id", "label", "split"), path)
    ds = splits.read_split_dataset(spark, path, required=["train", "validation"])
    return ds.groupBy("split").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))
