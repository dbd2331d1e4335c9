"""Queries: sequence encoding (T3, T4, T6, T7) and prompts with model
scoring (P1-P4, M3) on file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import WORD, word_tokens
from tessera.operators import answers as ans
from tessera.operators import prompts, scoring, sequences as sq, vocab as pv
from tessera.plans.q_answers import LLM_SQL
from tessera.plans.q_genmetrics import sql_split
from tessera.plans.q_models import echo_model
from tessera.plans.q_sequences import FIXED_LEN, INSTR_LEN, SEQ_LEN, SQL_DOC_VOCAB, doc_vocab, ids_md5, sql_lit
from tessera.plans.registry import register
from tessera.streaming.rowwise import read_table_stream, run_available

INSTRUCTION = "Name the source of this text."

# ------------------------------------------------------------- T3, T4, T6, T7


def token_arrays(docs: DataFrame) -> DataFrame:
    """The tokens of the text, of an instruction prompt about it, and of
    the answer."""
    asked = docs.withColumn("instruction", F.lit(INSTRUCTION)).withColumn("input", F.col("text"))
    return asked.select("doc_id", word_tokens("text").alias("tokens"),
                        word_tokens(prompts.instruction_prompt("instruction", "input")).alias("prompt"),
                        word_tokens(F.coalesce("source", F.lit(""))).alias("target"))


def encoded(ids: DataFrame) -> DataFrame:
    """T4, T6 and T7 of the id arrays ``ids``, ``p`` and ``y``, row by row."""
    fixed, mask, _ = sq.encode_fixed(F.col("ids"), FIXED_LEN)
    out = sq.encode_instruction(ids, "p", "y", INSTR_LEN)
    return out.select("doc_id", F.size("ids").alias("n_tokens"), F.size(F.filter("ids", lambda x: x == sq.UNK)).alias("n_unk"),
                      ids_md5(F.col("ids")).alias("ids_md5"), ids_md5(sq.wrap_truncate(F.col("ids"), SEQ_LEN)).alias("seq_md5"),
                      ids_md5(fixed).alias("fixed_md5"), F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("n_real"),
                      ids_md5(F.col("input_ids")).alias("instr_md5"), ids_md5(F.col("labels")).alias("labels_md5"))


def rowwise_encoder(vocab: DataFrame):
    """A transform for streams: every step works on a row by itself."""
    packed = pv.need_packed(vocab)

    def transform(docs: DataFrame) -> DataFrame:
        t = token_arrays(docs)
        return encoded(t.select("doc_id", pv.ids_of(F.col("tokens"), packed).alias("ids"),
                                pv.ids_of(F.col("prompt"), packed).alias("p"), pv.ids_of(F.col("target"), packed).alias("y")))

    return transform


def joined_encoder(vocab: DataFrame):
    """The same for micro-batches under a vocabulary of any size."""
    def transform(docs: DataFrame) -> DataFrame:
        columns = {"tokens": "ids", "prompt": "p", "target": "y"}
        return encoded(sq.lookup_ids(token_arrays(docs), "doc_id", columns, vocab, most_bytes=0))

    return transform


def _ids(array: str) -> str:
    return (f"SELECT doc_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM (SELECT doc_id, unnest({array}) AS token, "
            f"unnest(range(len({array}))) AS pos FROM stok) LEFT JOIN vocab v USING (token) GROUP BY doc_id")


_TEXT = sql_lit("Instruction: " + INSTRUCTION)
STREAM_ENCODE_SQL = f"""
WITH {SQL_DOC_VOCAB},
stok AS (SELECT doc_id, regexp_extract_all(lower(text), '({WORD}+)', 1) AS t,
                regexp_extract_all(lower(CASE WHEN coalesce(text, '') <> '' THEN 'Input: ' || text || chr(10) || {_TEXT}
                                              ELSE {_TEXT} END), '({WORD}+)', 1) AS pt,
                regexp_extract_all(lower(coalesce(source, '')), '({WORD}+)', 1) AS yt FROM documents),
a AS ({_ids('t')}), b AS ({_ids('pt')}), c AS ({_ids('yt')}),
j AS (SELECT doc_id, coalesce(a.ids, []::INTEGER[]) AS ids, coalesce(b.ids, []::INTEGER[]) AS p,
             list_concat(coalesce(c.ids, []::INTEGER[]), [3]) AS y
      FROM stok LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)),
k AS (SELECT *, len(p) + len(y) - {INSTR_LEN} AS cut, list_resize([]::INTEGER[], len(p), -100) AS off,
             list_concat([2], ids[1:{FIXED_LEN - 2}], [3]) AS core FROM j),
m AS (SELECT *, CASE WHEN cut <= 0 THEN list_concat(p, y) WHEN cut < len(y) THEN list_concat(p, y[cut + 1:])
                     ELSE list_concat(p, y)[-{INSTR_LEN}:] END AS x,
             CASE WHEN cut <= 0 THEN list_concat(off, y) WHEN cut < len(y) THEN list_concat(off, y[cut + 1:])
                  ELSE list_concat(off, y)[-{INSTR_LEN}:] END AS lab FROM k)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, CAST(len(list_filter(ids, lambda x: x = 0)) AS INTEGER) AS n_unk,
       md5(array_to_string(ids, ' ')) AS ids_md5, md5(array_to_string(list_concat([2], ids[1:{SEQ_LEN - 2}], [3]), ' ')) AS seq_md5,
       md5(array_to_string(list_resize(core, {FIXED_LEN}, 1), ' ')) AS fixed_md5, CAST(len(core) AS INTEGER) AS n_real,
       md5(array_to_string(list_resize(x, {INSTR_LEN}, 1), ' ')) AS instr_md5,
       md5(array_to_string(list_resize(lab, {INSTR_LEN}, -100), ' ')) AS labels_md5 FROM m"""


@register("stream_encode", STREAM_ENCODE_SQL)
def q_stream_encode(spark, sf_dir):
    """T1, T3, T4 (up to padding), T6 and T7 over ``documents`` read as a
    file stream, by the vocabulary of the training split."""
    _, vocab = doc_vocab(spark, sf_dir)
    return run_available(spark, read_table_stream(spark, sf_dir, "documents"), rowwise_encoder(vocab))

# ------------------------------------------------------------- P1 - P4, M3


def prompt_transform(items: DataFrame) -> DataFrame:
    """P1 to P4, then M3 on the zero-shot prompt and C3 on its response."""
    t = items.withColumn("translation", F.create_map(F.lit("en"), F.col("text"), F.lit("id"), F.col("item_id").cast("string")))
    t = t.select("item_id", F.struct(
        "item_id", F.md5(prompts.project_lang("translation", "en")).alias("lang_md5"),
        F.md5(prompts.instruction_prompt(F.lit(INSTRUCTION), F.col("text"))).alias("instruction_md5"),
        F.md5(prompts.few_shot_prompt("text")).alias("few_shot_md5")).alias("row"),
        prompts.zero_shot_prompt("text").alias("prompt"))
    scored = ans.llm_answer(scoring.batch_score(t, echo_model, "prompt", "row"), "response")
    return scored.select("row.*", "response", "error", "llm_answer")


STREAM_PROMPTS_SQL = ("WITH p AS (SELECT *, 'Question: ' || text || chr(10) || " + sql_lit(prompts.STEP_CUE) + " AS prompt FROM benchmark),\n"
                      "w AS (SELECT *, " + sql_split("prompt") + " AS words FROM p),\n"
                      "responses AS (SELECT item_id AS doc_id, '<think>' || array_to_string(words[1:5], ' ') || '</think>' || chr(10)"
                      " || 'Counting words.' || chr(10) || 'Answer: ' || CAST(len(words) AS VARCHAR) AS response FROM w),\n" + LLM_SQL +
                      "\nSELECT p.item_id, md5(text) AS lang_md5, md5(CASE WHEN coalesce(text, '') <> '' THEN 'Input: ' || text || chr(10) || "
                      + _TEXT + " ELSE " + _TEXT + " END) AS instruction_md5, md5(" + sql_lit(prompts.few_shot_prefix() + "Q: ") + " || text || "
                      + sql_lit(chr(10) + "A: " + prompts.STEP_CUE + chr(10)) + ") AS few_shot_md5, r.response, CAST(NULL AS VARCHAR) AS error,"
                      " model_ans.llm_answer FROM p JOIN responses r ON r.doc_id = p.item_id JOIN model_ans ON model_ans.doc_id = p.item_id")


@register("stream_prompts", STREAM_PROMPTS_SQL)
def q_stream_prompts(spark, sf_dir):
    """P1-P4, M3 and C3 over ``benchmark`` read as a file stream."""
    return run_available(spark, read_table_stream(spark, sf_dir, "benchmark"), prompt_transform)
