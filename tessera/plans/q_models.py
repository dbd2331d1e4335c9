"""Queries: reranking (M5), dot-product softmax lookup (M6), batch scoring
with a user model (M3), user tokenizer UDF (U1)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera.functions.text import WS
from tessera.operators import answers as ans
from tessera.operators import prompts, scoring
from tessera.operators.vectors import dot_softmax_lookup
from tessera.plans import fixtures as fx
from tessera.plans.registry import R6, r6, register
from tessera.plans.q_answers import LLM_SQL
from tessera.plans.q_genmetrics import sql_split
from tessera.plans.q_sequences import sql_lit
from tessera.session import ship_package
from tessera.sources.tables import read_table

BEAMS = 4
PENALTY = 0.7   # the reference's default length penalty


@register("rerank_length_penalty", fx.with_views(f"""
WITH s AS (SELECT *, score / pow(CAST(length AS DOUBLE), {PENALTY}) AS norm FROM nbest),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY norm DESC, cand_id) AS rank FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, cand_id, {R6('norm')} AS norm,
       bool_and(ended) OVER (PARTITION BY item_id) AS all_finished
FROM r WHERE rank <= {BEAMS}""", "nbest"))
def q_rerank(spark, sf_dir):
    r = scoring.rerank_length_penalty(fx.nbest(spark, sf_dir), BEAMS, PENALTY)
    return r.select("item_id", "rank", "cand_id", r6("norm").alias("norm"), "all_finished")


@register("rerank_best", fx.with_views(f"""
WITH s AS (SELECT item_id, cand_id, score / pow(CAST(length AS DOUBLE), {PENALTY}) AS norm,
                  list_transform(range(1, length + 1), lambda i: CAST((cand_id + i) % 7 AS INTEGER)) AS t FROM nbest),
b AS (SELECT item_id, cand_id, norm, CASE WHEN list_position(t, 2) > 0 THEN t[1:list_position(t, 2)] ELSE t END AS t FROM s
      QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY norm DESC, cand_id) = 1),
m AS (SELECT max(len(t)) AS longest FROM b)
SELECT item_id, cand_id, {R6('norm')} AS norm,
       array_to_string(list_concat(t, list_transform(range(longest - len(t)), lambda i: 0)), ' ') AS tokens FROM b, m""", "nbest"))
def q_rerank_best(spark, sf_dir):
    ids = F.transform(F.sequence(F.lit(1), "length"), lambda i: ((F.col("cand_id") + i) % 7).cast("int"))
    best = scoring.pick_best(fx.nbest(spark, sf_dir).withColumn("tokens", ids), BEAMS, PENALTY, eos=2, pad=0)
    return best.select("item_id", "cand_id", r6("norm").alias("norm"), F.concat_ws(" ", F.col("tokens").cast("array<string>")).alias("tokens"))


@register("dot_softmax_lookup", fx.with_views(f"""
WITH s AS (SELECT q.grp, q.pos AS qpos, list_dot_product(q.vec, k.vec) / 8.0 AS sc,
                  list_dot_product(q.vec, k.vec) AS qk, list_sum(k.vec) AS ks
           FROM qkv q JOIN qkv k ON q.grp = k.grp AND k.pos <= q.pos),
w AS (SELECT grp, qpos, exp(sc - max(sc) OVER (PARTITION BY grp, qpos)) AS e, qk, ks FROM s),
n AS (SELECT grp, qpos, e / sum(e) OVER (PARTITION BY grp, qpos) AS wt, qk, ks FROM w)
SELECT CAST(grp AS BIGINT) AS grp, qpos AS pos, count(*) AS n_keys, {R6('max(wt)')} AS max_weight,
       {R6('sum(wt * qk)')} AS out_dot_q, {R6('sum(wt * ks)')} AS out_sum
FROM n GROUP BY grp, qpos""", "qkv"))
def q_dot_softmax(spark, sf_dir):
    q = fx.qkv(spark, sf_dir).withColumn("grp", F.col("grp").cast("long"))
    d = dot_softmax_lookup(q, causal=True, with_vector=False)
    return d.select("grp", "pos", "n_keys", *[r6(c).alias(c) for c in ("max_weight", "out_dot_q", "out_sum")])


def echo_model():
    """A stand-in generator (loaded once per partition): it answers with
    the question's word count, in the reasoning-then-answer layout."""
    def run(prompts_: list[str]) -> list[str]:
        out = []
        for p in prompts_:
            words = p.split()
            out.append(f"<think>{' '.join(words[:5])}</think>\nCounting words.\nAnswer: {len(words)}")
        return out
    return run


BATCH_SQL = ("WITH p AS (SELECT item_id, 'Question: ' || text || chr(10) || " + sql_lit(prompts.STEP_CUE) +
             " AS prompt FROM benchmark),\nw AS (SELECT item_id, " + sql_split("prompt") + " AS words FROM p),\n"
             "responses AS (SELECT item_id AS doc_id, '<think>' || array_to_string(words[1:5], ' ') || '</think>' || chr(10)"
             " || 'Counting words.' || chr(10) || 'Answer: ' || CAST(len(words) AS VARCHAR) AS response FROM w),\n"
             + LLM_SQL + "\nSELECT r.doc_id AS item_id, r.response, CAST(NULL AS VARCHAR) AS error, model_ans.llm_answer"
             " FROM responses r JOIN model_ans USING (doc_id)")


@register("batch_score", BATCH_SQL)
def q_batch_score(spark, sf_dir):
    """M3: zero-shot prompts over ``benchmark`` through a user
    model in ``mapInPandas``, then answer extraction (C3)."""
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    pr = b.select("item_id", prompts.zero_shot_prompt("text").alias("prompt"))
    scored = scoring.batch_score(pr, echo_model, "prompt", "item_id")
    return ans.llm_answer(scored, "response").select("item_id", "response", "error", "llm_answer")


# The user tokenizer of the U1 query: letter runs, digit runs, and any other
# non-space symbol (whitespace as Python's str.split sees it).
USER_TOKEN_RE = r"\p{L}+|\p{N}+|[^\p{L}\p{N}" + WS[1:-1] + "]"
# the same pattern in Python's regex syntax (\uHHHH instead of \x{HHHH})
_USER_TOKEN_PY = re.sub(r"\\x\{([0-9A-Fa-f]{4})\}", r"\\u\1", USER_TOKEN_RE)


def _user_tokenizer(text: str) -> list[str]:
    import regex
    return regex.findall(_USER_TOKEN_PY, text)


@register("udf_tokenizer", "SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 "
          "FROM (SELECT doc_id, regexp_extract_all(text, '(" + USER_TOKEN_RE + ")', 1) AS t FROM documents)")
def q_udf_tokenizer(spark, sf_dir):
    """A user tokenizer callable as an Arrow UDF over documents."""
    ship_package(spark)
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    tok = scoring.udf_tokenizer(_user_tokenizer)
    return d.select("doc_id", tok("text").alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"))
