"""Queries: training-log analytics (S4, A2, A3, A5, A7, W1-W6, W8, W9) and
logit metrics (M4, A4, A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clfmetrics as cm
from tessera.operators import runs
from tessera.plans import fixtures as fx
from tessera.plans.registry import r6, register

PATIENCE = 3
MIN_DELTA = 0.01
SAVE_EVERY = 3
SAVE_STEPS = 50
LOG_STEPS = 10
# The three classifier families compared, by run_id % 3.
FAMILIES = ["bert", "bilstm", "lr"]


def _el(spark, sf_dir):
    return fx.epoch_log(spark, sf_dir)


@register("loss_curve", fx.with_views("""
SELECT run_id, epoch,
       floor((avg(CASE WHEN event_type NOT IN ('purchase', 'signup') THEN loss END)) * 1e6 + 0.5) / 1e6 AS training,
       floor((avg(CASE WHEN event_type IN ('purchase', 'signup') THEN loss END)) * 1e6 + 0.5) / 1e6 AS validation
FROM train_log GROUP BY run_id, epoch""", "train_log"))
def q_loss_curve(spark, sf_dir):
    tl = fx.train_log(spark, sf_dir)
    phase = F.when(F.col("event_type").isin("purchase", "signup"), F.lit("validation")).otherwise(F.lit("training"))
    c = runs.loss_curve(tl, phase)
    return c.select("run_id", "epoch", r6("training").alias("training"), r6("validation").alias("validation"))


@register("loss_mean_of_batches", fx.with_views("""
WITH b AS (SELECT run_id, epoch, (micro - 1) // 4 AS batch, avg(loss) AS batch_loss FROM train_log
           GROUP BY run_id, epoch, batch)
SELECT run_id, epoch, floor((avg(batch_loss)) * 1e6 + 0.5) / 1e6 AS epoch_loss, count(*) AS n_batches
FROM b GROUP BY run_id, epoch""", "train_log"))
def q_loss_mob(spark, sf_dir):
    a = cm.loss_mean_of_batches(fx.train_log(spark, sf_dir, ("micro",)), 4)
    return a.select("run_id", "epoch", r6("epoch_loss").alias("epoch_loss"), "n_batches")


@register("loss_token_weighted", fx.with_views("""
SELECT run_id, epoch, floor((sum(loss * tokens) / greatest(sum(tokens), 1)) * 1e6 + 0.5) / 1e6 AS epoch_loss,
       CAST(sum(tokens) AS BIGINT) AS tokens FROM train_log GROUP BY run_id, epoch""", "train_log"))
def q_loss_tw(spark, sf_dir):
    a = cm.loss_token_weighted(fx.train_log(spark, sf_dir))
    return a.select("run_id", "epoch", r6("epoch_loss").alias("epoch_loss"), "tokens")


@register("lm_metrics", fx.with_views("""
WITH a AS (SELECT run_id, epoch, sum(loss * tokens) / greatest(sum(tokens), 1) AS loss FROM train_log
           GROUP BY run_id, epoch)
SELECT run_id, epoch, floor((loss) * 1e6 + 0.5) / 1e6 AS loss,
       floor((CASE WHEN loss < 20 THEN exp(loss) ELSE 'inf'::DOUBLE END) * 1e6 + 0.5) / 1e6 AS perplexity,
       floor((loss / ln(2.0)) * 1e6 + 0.5) / 1e6 AS bits_per_token FROM a""", "train_log"))
def q_lm_metrics(spark, sf_dir):
    a = cm.loss_token_weighted(fx.train_log(spark, sf_dir)).withColumnRenamed("epoch_loss", "loss")
    ppl, bpt = cm.lm_metrics(F.col("loss"))
    return a.select("run_id", "epoch", r6("loss").alias("loss"), r6(ppl).alias("perplexity"),
                    r6(bpt).alias("bits_per_token"))


@register("tokens_per_second", fx.with_views("""
SELECT run_id, epoch, tokens, floor((tokens / greatest(seconds, 1e-9)) * 1e6 + 0.5) / 1e6 AS tokens_per_second
FROM epoch_log""", "epoch_log"))
def q_tps(spark, sf_dir):
    e = _el(spark, sf_dir)
    return e.select("run_id", "epoch", "tokens",
                    r6(cm.tokens_per_second(F.col("tokens"), F.col("seconds"))).alias("tokens_per_second"))


BEST_SQL = """
flags AS (SELECT *, val_f1 > coalesce(max(val_f1) OVER (PARTITION BY run_id ORDER BY epoch
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS is_best,
                 (epoch % {se} = 0 OR epoch = max(epoch) OVER (PARTITION BY run_id)) AS periodic
          FROM epoch_log)""".format(se=SAVE_EVERY)


@register("best_epoch_flags", fx.with_views("WITH " + BEST_SQL + """
SELECT run_id, epoch, floor((val_f1) * 1e6 + 0.5) / 1e6 AS val_f1, is_best FROM flags""", "epoch_log"))
def q_best_flags(spark, sf_dir):
    f = runs.best_epoch_flags(_el(spark, sf_dir))
    return f.select("run_id", "epoch", r6("val_f1").alias("val_f1"), "is_best")


@register("early_stop_epoch", fx.with_views(f"""
WITH RECURSIVE e AS (SELECT run_id, epoch, val_loss,
                            row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS k FROM epoch_log),
f(run_id, k, best, best_epoch, lft, stopped) AS (
    SELECT DISTINCT run_id, CAST(0 AS BIGINT), 'inf'::DOUBLE, CAST(NULL AS INTEGER), {PATIENCE}, CAST(NULL AS INTEGER)
    FROM e
    UNION ALL
    SELECT f.run_id, f.k + 1,
           CASE WHEN f.best - e.val_loss > {MIN_DELTA} THEN e.val_loss ELSE f.best END,
           CASE WHEN f.best - e.val_loss > {MIN_DELTA} THEN e.epoch ELSE f.best_epoch END,
           CASE WHEN f.best - e.val_loss > {MIN_DELTA} THEN {PATIENCE} ELSE f.lft - 1 END,
           CASE WHEN f.best - e.val_loss > {MIN_DELTA} THEN NULL WHEN f.lft - 1 = 0 THEN e.epoch ELSE NULL END
    FROM f JOIN e ON e.run_id = f.run_id AND e.k = f.k + 1 WHERE f.stopped IS NULL),
fin AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY k DESC) = 1),
last AS (SELECT run_id, max(epoch) AS last_epoch FROM epoch_log GROUP BY run_id)
SELECT run_id, stopped AS stopped_epoch, best_epoch, floor((best) * 1e6 + 0.5) / 1e6 AS best_value,
       coalesce(stopped, last_epoch) AS epochs_run FROM fin JOIN last USING (run_id)""", "epoch_log"))
def q_early_stop(spark, sf_dir):
    s = runs.early_stop(_el(spark, sf_dir), PATIENCE, MIN_DELTA)
    return s.select("run_id", "stopped_epoch", "best_epoch", r6("best_value").alias("best_value"), "epochs_run")


@register("save_points", fx.with_views(f"""
WITH p AS (SELECT run_id, epoch, CAST(sum(CASE WHEN step % {SAVE_STEPS} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS save_points,
                  CAST(sum(CASE WHEN step % {LOG_STEPS} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS log_points
           FROM train_log GROUP BY run_id, epoch),
""" + BEST_SQL + """
SELECT run_id, epoch, periodic, save_points, log_points FROM flags JOIN p USING (run_id, epoch)""",
                                       "train_log", "epoch_log"))
def q_save_points(spark, sf_dir):
    e = runs.save_points(_el(spark, sf_dir), SAVE_EVERY)
    s = runs.step_points(fx.train_log(spark, sf_dir, ("step",)), SAVE_STEPS, LOG_STEPS)
    return e.join(s, ["run_id", "epoch"]).select("run_id", "epoch", "periodic", "save_points", "log_points")


@register("epoch_time_mean", fx.with_views("""
SELECT run_id, epoch, floor((avg(seconds) OVER (PARTITION BY run_id ORDER BY epoch
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) * 1e6 + 0.5) / 1e6 AS mean_epoch_seconds FROM epoch_log""", "epoch_log"))
def q_epoch_time_mean(spark, sf_dir):
    e = runs.epoch_time_mean(_el(spark, sf_dir))
    return e.select("run_id", "epoch", r6("mean_epoch_seconds").alias("mean_epoch_seconds"))


@register("total_time", fx.with_views("""
SELECT run_id, floor((sum(seconds)) * 1e6 + 0.5) / 1e6 AS total_seconds, floor((arg_max(seconds, epoch)) * 1e6 + 0.5) / 1e6 AS latest_epoch_seconds,
       count(*) AS epochs FROM epoch_log GROUP BY run_id""", "epoch_log"))
def q_total_time(spark, sf_dir):
    t = runs.total_time(_el(spark, sf_dir))
    return t.select("run_id", r6("total_seconds").alias("total_seconds"),
                    r6("latest_epoch_seconds").alias("latest_epoch_seconds"), "epochs")


@register("pick_checkpoint", fx.with_views("WITH " + BEST_SQL + """,
g AS (SELECT run_id, max(CASE WHEN is_best THEN epoch END) AS best_e, max(CASE WHEN periodic THEN epoch END) AS per_e,
             max(CASE WHEN is_best THEN printf('model_best_epoch%d.pt', epoch) END) AS best_lex,
             max(CASE WHEN periodic THEN printf('model_epoch%d.pt', epoch) END) AS per_lex
      FROM flags GROUP BY run_id)
SELECT run_id, CASE WHEN best_e IS NOT NULL THEN printf('model_best_epoch%d.pt', best_e)
                    ELSE printf('model_epoch%d.pt', per_e) END AS ckpt_numeric,
       coalesce(best_lex, per_lex) AS ckpt_lexicographic FROM g""", "epoch_log"))
def q_pick_checkpoint(spark, sf_dir):
    f = runs.save_points(runs.best_epoch_flags(_el(spark, sf_dir)), SAVE_EVERY)
    return runs.pick_checkpoint(f)


RECORD_SQL = """
per_run AS (SELECT run_id, max(epoch) AS epoch, CAST(sum(n_batches) AS BIGINT) AS global_step,
                   arg_max(train_loss, epoch) AS train_loss, arg_max(val_loss, epoch) AS val_loss,
                   arg_max(val_f1, epoch) AS val_f1, max(val_f1) AS best_val_f1,
                   avg(seconds) AS time_per_epoch, sum(seconds) AS total_time
            FROM epoch_log GROUP BY run_id)"""


def per_run(spark, sf_dir):
    e = _el(spark, sf_dir)
    return e.groupBy("run_id").agg(
        F.max("epoch").alias("epoch"), F.sum("n_batches").cast("long").alias("global_step"),
        F.max_by("train_loss", "epoch").alias("train_loss"), F.max_by("val_loss", "epoch").alias("val_loss"),
        F.max_by("val_f1", "epoch").alias("val_f1"), F.max("val_f1").alias("best_val_f1"),
        F.avg("seconds").alias("time_per_epoch"), F.sum("seconds").alias("total_time"))


@register("run_record", fx.with_views("WITH " + RECORD_SQL + """
SELECT run_id, epoch, global_step, floor((train_loss) * 1e6 + 0.5) / 1e6 AS train_loss, floor((val_loss) * 1e6 + 0.5) / 1e6 AS val_loss,
       floor((val_f1) * 1e6 + 0.5) / 1e6 AS val_f1, floor((best_val_f1) * 1e6 + 0.5) / 1e6 AS best_val_f1, CAST(NULL AS DOUBLE) AS test_loss,
       floor((time_per_epoch) * 1e6 + 0.5) / 1e6 AS time_per_epoch, floor((total_time) * 1e6 + 0.5) / 1e6 AS total_time FROM per_run""",
                                      "epoch_log"))
def q_run_record(spark, sf_dir):
    """The ledger record per run, flattened (test metrics NULL: no test split)."""
    p = per_run(spark, sf_dir)
    return p.select("run_id", "epoch", "global_step", *[r6(c).alias(c) for c in
                                                        ("train_loss", "val_loss", "val_f1", "best_val_f1")],
                    F.lit(None).cast("double").alias("test_loss"),
                    r6("time_per_epoch").alias("time_per_epoch"), r6("total_time").alias("total_time"))


RUN_METRICS = ["best_val_f1", "val_loss", "epoch"]


@register("run_compare", fx.with_views("WITH " + RECORD_SQL + """,
fam AS (SELECT CASE run_id % 3 WHEN 0 THEN 'bert' WHEN 1 THEN 'bilstm' ELSE 'lr' END AS family, * FROM per_run),
long AS (SELECT family, 'best_val_f1' AS metric, best_val_f1 AS value FROM fam
         UNION ALL SELECT family, 'val_loss', val_loss FROM fam
         UNION ALL SELECT family, 'epoch', CAST(epoch AS DOUBLE) FROM fam)
SELECT metric, floor((avg(CASE WHEN family = 'bert' THEN value END)) * 1e6 + 0.5) / 1e6 AS bert,
       floor((avg(CASE WHEN family = 'bilstm' THEN value END)) * 1e6 + 0.5) / 1e6 AS bilstm,
       floor((avg(CASE WHEN family = 'lr' THEN value END)) * 1e6 + 0.5) / 1e6 AS lr FROM long GROUP BY metric""", "epoch_log"))
def q_run_compare(spark, sf_dir):
    fam = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.col("run_id") % 3 + 1).cast("int"))
    p = per_run(spark, sf_dir).withColumn("family", fam)
    c = runs.run_compare(p, "family", RUN_METRICS, FAMILIES)
    return c.select("metric", *[r6(f).alias(f) for f in FAMILIES])

# ------------------------------------------------------------- logits: M4, A4, A6


LSE_SQL = "(list_max(logits) + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))))"


@register("softmax_argmax", fx.with_views(f"""
SELECT vec_id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS argmax,
       floor((exp(list_max(logits) - {LSE_SQL})) * 1e6 + 0.5) / 1e6 AS max_prob, floor(({LSE_SQL}) * 1e6 + 0.5) / 1e6 AS logsumexp
FROM logits""", "logits"))
def q_softmax_argmax(spark, sf_dir):
    s = cm.softmax_argmax(fx.logits(spark, sf_dir))
    return s.select("vec_id", "argmax", r6("max_prob").alias("max_prob"), r6("logsumexp").alias("logsumexp"))


CE_SQL = f"SELECT vec_id, floor(({LSE_SQL} - logits[gold + 1]) * 1e6 + 0.5) / 1e6 AS ce FROM logits WHERE gold <> 0"


@register("cross_entropy", fx.with_views(CE_SQL, "logits"))
def q_cross_entropy(spark, sf_dir):
    c = cm.cross_entropy(fx.logits(spark, sf_dir))
    return c.select("vec_id", r6("ce").alias("ce"))


@register("token_accuracy", fx.with_views("""
WITH p AS (SELECT seq_id, pos, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS pred, gold
           FROM logits),
s AS (SELECT 0 AS shift, pred, gold AS l FROM p
      UNION ALL SELECT 1 AS shift, pred, lead(gold) OVER (PARTITION BY seq_id ORDER BY pos) AS l FROM p)
SELECT shift, CAST(sum(CASE WHEN pred = l THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total,
       floor((sum(CASE WHEN pred = l THEN 1 ELSE 0 END) / greatest(count(*), 1)) * 1e6 + 0.5) / 1e6 AS token_accuracy
FROM s WHERE l IS NOT NULL AND l <> 0 GROUP BY shift""", "logits"))
def q_token_accuracy(spark, sf_dir):
    p = cm.softmax_argmax(fx.logits(spark, sf_dir))
    parts = [cm.token_accuracy(p, "seq_id", "pos", "argmax", "gold", shift=s) for s in (0, 1)]
    u = parts[0].unionByName(parts[1])
    return u.select("shift", "correct", "total", r6("token_accuracy").alias("token_accuracy"))
