"""Views over the driver tables that stand in for the reference's inputs.

Each view exists twice with the same meaning: a Spark builder
(``spark, sf_dir -> DataFrame``) and a DuckDB SQL body used by the
oracle.  The view definitions are in FIXTURES.md section B.

Scale notes: every view is a per-row projection or a window partitioned
by an entity key (conversation, run); none needs a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.scoring import top_k_per_group
from tessera.plans.ranking import grouped_rank
from tessera.sources.tables import read_table

# ---------------------------------------------------------------- Spark side


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", "lang", F.col("quality").alias("label"))


def clf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return labels.select("doc_id", F.col("quality").alias("gold"),
                         (F.lit(1) - F.col("toxic")).alias("pred"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conv.select(
        "conv_id", "turn", "role", "text",
        F.lead("role").over(w).alias("next_role"),
        F.lead("text").over(w).alias("next_text"))
    return nxt.filter((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        (F.col("conv_id") * (1 << 32) + F.col("turn")).alias("pair_id"), "conv_id",
        F.col("text").alias("prediction"), F.col("next_text").alias("reference"))


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    system = (conv.filter(F.col("role") == "system").groupBy("conv_id")
              .agg(F.min_by("text", "turn").alias("input")))
    return pairs(spark, sf_dir).join(system, "conv_id", "left").select(
        "pair_id", F.col("prediction").alias("instruction"), "input",
        F.col("reference").alias("output"))


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select(
        "pair_id",
        F.create_map(F.lit("en"), F.col("prediction"), F.lit("cs"), F.col("reference"))
        .alias("translation"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select(
        "vec_id", (F.col("vec_id") / 10).cast("long").alias("seq_id"),
        (F.col("vec_id") % 10).alias("pos"),
        F.transform("embedding", lambda x: x.cast("double")).alias("logits"),
        F.col("label").alias("gold"))


def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return emb.select(
        (F.col("vec_id") / 10).cast("long").alias("pair_id"),
        (F.col("vec_id") % 2).alias("side"), F.col("vec_id").alias("pos"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def qkv(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return emb.select(
        F.floor(F.col("vec_id") / 64).alias("grp"), (F.col("vec_id") % 64).alias("pos"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def train_log(spark: SparkSession, sf_dir: str, numbers: tuple[str, ...] = ()) -> DataFrame:
    """Training log.  ``numbers``: which of ``micro`` (place in the epoch)
    and ``step`` (place in the run) to count, each at the cost of a sort."""
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    base = ev.select(
        F.col("user_id").alias("run_id"), "event_id", "ts", "event_type",
        F.to_date("ts").alias("day"), (F.round(F.col("value") * 100).cast("long") / 1024.0).alias("loss"),
        F.get_json_object("props", "$.k").cast("int").alias("tokens"))
    # epoch = rank of the day among the run's days: ranked on the distinct
    # (run, day) pairs, a few rows per run whatever the run's size
    days = base.select("run_id", "day").distinct()
    days = days.withColumn("epoch", F.dense_rank().over(
        Window.partitionBy("run_id").orderBy("day")).cast("int"))
    days = days.withColumnsRenamed({"run_id": "_run", "day": "_day"})
    base = base.join(days, F.col("run_id").eqNullSafe(F.col("_run")) & F.col("day").eqNullSafe(F.col("_day")))
    # positions inside a run / an epoch, counted minute by minute: a run with
    # a third of all events is many short windows
    minute = F.date_trunc("minute", "ts")
    groups = {"micro": ["run_id", "epoch"], "step": ["run_id"]}
    for name in numbers:
        base = grouped_rank(base, groups[name], ["ts", "event_id"], minute, name)
        base = base.withColumn(name, (F.col(name) + 1).cast("int"))
    return base.select("run_id", "epoch", *numbers, "event_id", "ts", "event_type", "loss", "tokens")


def epoch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    tl = train_log(spark, sf_dir)
    return tl.groupBy("run_id", "epoch").agg(
        (F.sum(F.col("loss") * F.col("tokens")) /
         F.greatest(F.sum("tokens"), F.lit(1))).alias("train_loss"),
        F.avg("loss").alias("val_loss"),
        F.avg(F.when(F.col("event_type").isin("purchase", "signup"), 1.0)
              .otherwise(0.0)).alias("val_f1"),
        F.count("*").alias("n_batches"),
        F.sum("tokens").cast("long").alias("tokens"), F.max("ts").alias("last_ts"),
        (F.unix_seconds(F.max("ts").cast("timestamp")) -
         F.unix_seconds(F.min("ts").cast("timestamp"))).cast("double").alias("seconds"))


def samples(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    """Answers sampled for each question, in order; ``most``: only the first
    so many of each, without numbering the others."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    # The answer domain is a small categorical set: a scalar subquery (one
    # aggregated row, evaluated once) gives the sorted list of types.
    types = ev.agg(F.array_sort(F.collect_set("event_type")).alias("t"))
    if most is None:
        ranked = grouped_rank(ev, ["user_id"], ["ts", "event_id"], F.date_trunc("minute", "ts"), "_idx")
    else:
        first = top_k_per_group(ev, "user_id", [F.col("ts"), F.col("event_id")], most, "event_id")
        ranked = first.withColumn("_idx", F.col("rank") - 1)
    return ranked.select(
        F.col("user_id").alias("question_id"),
        F.col("_idx").cast("int").alias("sample_idx"),
        F.col("event_type").alias("answer"),
        F.try_element_at(types.scalar(), (F.col("user_id") % 5 + 1).cast("int")).alias("gold"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    nl = F.lit("\n")
    tail = (F.when(F.col("doc_id") % 4 == 0,
                   F.concat(nl, F.lit("Answer: "), F.col("n_chars").cast("string")))
            .when(F.col("doc_id") % 4 == 1, F.concat(nl, F.col("n_chars").cast("string")))
            .when(F.col("doc_id") % 4 == 2, F.concat(nl, F.lit("Answer")))
            .otherwise(F.lit("")))
    return d.select("doc_id", F.concat(
        F.lit("<think>"), F.expr("substring(text, 1, length(text) div 2)"), F.lit("</think>"), nl,
        F.expr("substring(text, 1 + length(text) div 2)"), tail).alias("response"))


def worked_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    return d.select("doc_id", F.concat(
        F.col("text"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("\n#### "), F.col("n_chars").cast("string"))))
        .alias("answer"))


def nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value", "props"])
    return ev.select(
        F.col("user_id").alias("item_id"), F.col("event_id").alias("cand_id"),
        (-F.col("value")).alias("score"),
        (F.get_json_object("props", "$.k").cast("int") + 1).alias("length"),
        (F.col("event_type") == "error").alias("ended"))


# ------------------------------------------------------------------ SQL side
# DuckDB bodies of the same views, used by the oracle.

SQL = {
    "labelled_text": """
        SELECT d.doc_id, d.text, d.lang, l.quality AS label
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "clf_predictions": """
        SELECT doc_id, quality AS gold, 1 - toxic AS pred FROM labels""",
    "pairs": """
        SELECT conv_id * 4294967296 + turn AS pair_id, conv_id, text AS prediction,
               next_text AS reference
        FROM (SELECT conv_id, turn, role, text,
                     lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
                     lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
              FROM conversations) c
        WHERE role = 'user' AND next_role = 'assistant'""",
    "instructions": """
        SELECT p.pair_id, p.prediction AS instruction, s.input, p.reference AS output
        FROM pairs p LEFT JOIN (SELECT conv_id, min_by(text, turn) AS input
                                FROM conversations WHERE role = 'system'
                                GROUP BY conv_id) s ON p.conv_id = s.conv_id""",
    "translation": """
        SELECT pair_id, MAP {'en': prediction, 'cs': reference} AS translation FROM pairs""",
    "logits": """
        SELECT vec_id, vec_id // 10 AS seq_id, vec_id % 10 AS pos,
               CAST(embedding AS DOUBLE[]) AS logits, label AS gold FROM embeddings""",
    "token_vectors": """
        SELECT vec_id // 10 AS pair_id, vec_id % 2 AS side, vec_id AS pos,
               CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
    "qkv": """
        SELECT vec_id // 64 AS grp, vec_id % 64 AS pos, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
    "train_log": """
        SELECT run_id, epoch,
               CAST(row_number() OVER (PARTITION BY run_id, epoch ORDER BY ts, event_id) AS INTEGER) AS micro,
               CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS INTEGER) AS step,
               event_id, ts, event_type, loss, tokens
        FROM (SELECT user_id AS run_id, event_id, ts, event_type, CAST(round(value * 100) AS BIGINT) / 1024.0 AS loss,
                     CAST(json_extract_string(props, '$.k') AS INTEGER) AS tokens,
                     CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS INTEGER) AS epoch
              FROM events) b""",
    "epoch_log": """
        SELECT run_id, epoch,
               sum(loss * tokens) / greatest(sum(tokens), 1) AS train_loss,
               avg(loss) AS val_loss,
               avg(CASE WHEN event_type IN ('purchase', 'signup') THEN 1.0 ELSE 0.0 END) AS val_f1,
               count(*) AS n_batches, CAST(sum(tokens) AS BIGINT) AS tokens, max(ts) AS last_ts,
               CAST(epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000 AS DOUBLE) AS seconds
        FROM train_log GROUP BY run_id, epoch""",
    "samples": """
        SELECT user_id AS question_id,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS sample_idx,
               event_type AS answer,
               (SELECT list_sort(list(DISTINCT event_type)) FROM events)[user_id % 5 + 1] AS gold
        FROM events""",
    "responses": """
        SELECT doc_id, '<think>' || substr(text, 1, length(text) // 2) || '</think>' || chr(10) ||
               substr(text, 1 + length(text) // 2) ||
               CASE doc_id % 4 WHEN 0 THEN chr(10) || 'Answer: ' || CAST(n_chars AS VARCHAR)
                               WHEN 1 THEN chr(10) || CAST(n_chars AS VARCHAR)
                               WHEN 2 THEN chr(10) || 'Answer' ELSE '' END AS response
        FROM documents""",
    "worked_answers": """
        SELECT doc_id, text ||
               CASE WHEN doc_id % 7 = 0 THEN '' ELSE chr(10) || '#### ' || CAST(n_chars AS VARCHAR) END
               AS answer
        FROM documents""",
    "nbest": """
        SELECT user_id AS item_id, event_id AS cand_id, -value AS score,
               CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS length,
               event_type = 'error' AS ended
        FROM events""",
}

# Views a view's SQL body reads (besides base tables).
SQL_DEPS = {
    "instructions": ["pairs"],
    "translation": ["pairs"],
    "epoch_log": ["train_log"],
}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with a WITH clause defining ``views`` and their deps."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in SQL_DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    if not order:
        return body
    ctes = ",\n".join(f"{v} AS ({SQL[v]})" for v in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
