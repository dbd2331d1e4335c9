"""Queries: answer extraction and self-consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import NUMERIC, WS
from tessera.operators import answers as ans
from tessera.plans import fixtures as fx
from tessera.plans.registry import r6, register
from tessera.sources.tables import read_table

def strip_sql(x: str) -> str:
    return "regexp_replace(" + x + ", '^" + WS + "+|" + WS + "+$', '', 'g')"


def gold_sql(a: str) -> str:
    return ("CASE WHEN regexp_matches(" + a + ", '" + ans.GOLD + "') THEN "
            + strip_sql("regexp_extract(" + a + ", '" + ans.GOLD + "', 1)") + " END")


def think_sql(t: str) -> str:
    return "regexp_replace(" + t + ", '" + ans.THINK + "', '', 'g')"


LLM_SQL = """
l AS (SELECT doc_id, list_filter(list_transform(string_split(""" + think_sql("response") + """, chr(10)),
                     lambda x: """ + strip_sql("x") + """), lambda x: x <> '') AS lines FROM responses),
c AS (SELECT doc_id, lines,
             list_filter(list_transform(list_reverse(lines), lambda line:
                 CASE WHEN regexp_matches(line, '""" + NUMERIC + """') THEN line
                      WHEN contains(line, 'Answer') THEN
                          list_filter(regexp_split_to_array(line, '""" + WS + """+'),
                                      lambda w: regexp_matches(w, '""" + NUMERIC + """'))[1]
                      ELSE NULL END), lambda c: c IS NOT NULL)[1] AS found FROM l),
model_ans AS (SELECT doc_id, coalesce(found, lines[-1]) AS llm_answer FROM c)"""


@register("gold_answer", fx.with_views(
    "SELECT doc_id, " + gold_sql("answer") + " AS gold FROM worked_answers", "worked_answers"))
def q_gold_answer(spark, sf_dir):
    w = fx.worked_answers(spark, sf_dir)
    return w.select("doc_id", ans.gold_answer("answer").alias("gold"))


@register("strip_think", fx.with_views(
    "SELECT doc_id, " + think_sql("response") + " AS stripped FROM responses", "responses"))
def q_strip_think(spark, sf_dir):
    r = fx.responses(spark, sf_dir)
    return r.select("doc_id", ans.strip_think("response").alias("stripped"))


@register("llm_answer", fx.with_views("WITH " + LLM_SQL + "\nSELECT doc_id, llm_answer FROM model_ans", "responses"))
def q_llm_answer(spark, sf_dir):
    return ans.llm_answer(fx.responses(spark, sf_dir), "response").select("doc_id", "llm_answer")


@register("answer_accuracy", fx.with_views("WITH " + LLM_SQL + """,
g AS (SELECT doc_id, """ + gold_sql("answer") + """ AS gold FROM worked_answers),
j AS (SELECT d.lang, g.gold, model_ans.llm_answer AS pred FROM g JOIN model_ans USING (doc_id) JOIN documents d USING (doc_id))
SELECT lang, count(*) AS questions, count(gold) AS with_gold,
       CAST(sum(CASE WHEN gold IS NOT NULL AND pred IS NOT NULL AND contains(pred, gold) THEN 1 ELSE 0 END) AS BIGINT)
           AS correct,
       CAST(sum(CASE WHEN gold IS NOT NULL AND pred IS NOT NULL AND pred = gold THEN 1 ELSE 0 END) AS BIGINT)
           AS correct_exact,
       floor((sum(CASE WHEN gold IS NOT NULL AND pred IS NOT NULL AND contains(pred, gold) THEN 1 ELSE 0 END)
             / count(*)) * 1e6 + 0.5) / 1e6 AS accuracy
FROM j GROUP BY lang""", "responses", "worked_answers"))
def q_answer_accuracy(spark, sf_dir):
    g = fx.worked_answers(spark, sf_dir).select("doc_id", ans.gold_answer("answer").alias("gold"))
    p = ans.llm_answer(fx.responses(spark, sf_dir), "response").select("doc_id", F.col("llm_answer").alias("pred"))
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang"])
    j = g.join(p, "doc_id").join(d, "doc_id")
    sub = ans.is_correct(F.col("gold"), F.col("pred"))
    exact = ans.is_correct(F.col("gold"), F.col("pred"), "exact")
    return j.groupBy("lang").agg(
        F.count("*").alias("questions"), F.count("gold").alias("with_gold"),
        F.sum(sub).cast("long").alias("correct"), F.sum(exact).cast("long").alias("correct_exact"),
        r6(F.sum(sub) / F.count("*")).alias("accuracy"))


VOTE_SQL = """
per AS (SELECT {by}question_id, answer, count(*) AS votes, min(sample_idx) AS first_idx
        FROM {src} WHERE answer IS NOT NULL GROUP BY {by}question_id, answer),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {by}question_id ORDER BY votes DESC, first_idx) AS rk,
                  CAST(sum(votes) OVER (PARTITION BY {by}question_id) AS BIGINT) AS n_votes FROM per),
voted AS (SELECT {by}question_id, answer AS voted, votes, n_votes FROM ranked WHERE rk = 1),
golds AS (SELECT DISTINCT question_id, gold FROM samples)"""


@register("majority_vote", fx.with_views("WITH " + VOTE_SQL.format(by="", src="samples") + """
SELECT v.question_id, v.voted, v.votes, v.n_votes, g.gold,
       CASE WHEN g.gold IS NOT NULL AND contains(v.voted, g.gold) THEN 1 ELSE 0 END AS correct
FROM voted v JOIN golds g USING (question_id)""", "samples"))
def q_majority_vote(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    v = ans.majority_vote(s)
    g = s.groupBy("question_id").agg(F.max("gold").alias("gold"))
    return v.join(g, "question_id").select(
        "question_id", "voted", "votes", "n_votes", "gold",
        ans.is_correct(F.col("gold"), F.col("voted")).alias("correct"))


@register("self_consistency_sweep", fx.with_views("""
WITH t AS (SELECT s.*, ns.n FROM samples s JOIN (VALUES (1), (3), (5), (10)) ns(n) ON s.sample_idx < ns.n),
""" + VOTE_SQL.format(by="n, ", src="t") + """
SELECT v.n, CAST(sum(CASE WHEN g.gold IS NOT NULL AND contains(v.voted, g.gold) THEN 1 ELSE 0 END) AS BIGINT)
       AS correct, (SELECT count(*) FROM golds) AS questions,
       floor((sum(CASE WHEN g.gold IS NOT NULL AND contains(v.voted, g.gold) THEN 1 ELSE 0 END)
             / (SELECT count(*) FROM golds)) * 1e6 + 0.5) / 1e6 AS accuracy
FROM voted v JOIN golds g USING (question_id) GROUP BY v.n""", "samples"))
def q_sweep(spark, sf_dir):
    s = fx.samples(spark, sf_dir, most=max(ans.SWEEP_NS))
    g = s.groupBy("question_id").agg(F.max("gold").alias("gold"))
    out = ans.self_consistency_sweep(s, g)
    return out.select("n", "correct", "questions", r6("accuracy").alias("accuracy"))
