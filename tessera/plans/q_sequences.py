"""Queries: sampling/splitting (D1-D8), vocabulary and sequences (T2-T11),
prompts (P1-P4)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.text import WORD, word_tokens
from tessera.operators import prompts, sampling, scoring, sequences as sq
from tessera.plans import fixtures as fx
from tessera.plans.registry import register
from tessera.sources.tables import read_table

SEED = 42
THR10 = sampling.hex_threshold(0.1)
HEAD_N = 500
BATCH = 8
SEQ_LEN = 32
FIXED_LEN = 128
INSTR_LEN = 256
ACCUM = 4


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def md5_hash_sql(col: str) -> str:
    return f"md5(concat_ws(':', '{SEED}', CAST({col} AS VARCHAR)))"


def split_sql(col: str) -> str:
    return f"CASE WHEN substr({md5_hash_sql(col)}, 1, 8) < '{THR10}' THEN 'validation' ELSE 'train' END"


def ids_md5(c):
    return F.md5(F.array_join(c, " "))

# ------------------------------------------------------------- D1 - D8


@register("head_sample", f"""
SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT {HEAD_N}""")
def q_head_sample(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    return sampling.head_sample(d, "doc_id", HEAD_N)


@register("seeded_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {md5_hash_sql('doc_id')}, doc_id) - 1 AS shuffle_pos
FROM documents""")
def q_seeded_shuffle(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id"])
    return sampling.seeded_shuffle(d, "doc_id", SEED).select("doc_id", "shuffle_pos")


def _three_way_sql(col: str, train: float, val: float, test: float) -> str:
    t_hold = sampling.hex_threshold(1 - train)
    t_val = sampling.hex_threshold((1 - train) * val / (val + test))
    p = f"substr({md5_hash_sql(col)}, 1, 8)"
    return (f"CASE WHEN {p} < '{t_val}' THEN 'validation' WHEN {p} < '{t_hold}' THEN 'test' "
            f"ELSE 'train' END")


@register("split_three_way", f"""
SELECT doc_id, {_three_way_sql('doc_id', 0.8, 0.1, 0.1)} AS split FROM documents""")
def q_split_three_way(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id"])
    return sampling.split_three_way(d, "doc_id", 0.8, 0.1, 0.1, SEED)


@register("split_exact", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY substr({md5_hash_sql('doc_id')}, 1, 16), doc_id)
                         <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM documents""")
def q_split_exact(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id"])
    return sampling.split_exact(d, "doc_id", 0.1, SEED)


@register("split_if_missing", fx.with_views(f"""
SELECT doc_id, {_three_way_sql('doc_id', 0.96, 0.02, 0.02)} AS split FROM labelled_text""",
                                            "labelled_text"))
def q_split_if_missing(spark, sf_dir):
    only_train = fx.labelled_text(spark, sf_dir).select("doc_id", F.lit("train").alias("split"))
    return sampling.split_if_missing(only_train, "doc_id", 0.02, 0.02, SEED).select("doc_id", "split")


@register("batch_assign", fx.with_views(f"""
WITH s AS (SELECT doc_id, {_three_way_sql('doc_id', 0.8, 0.1, 0.1)} AS split FROM labelled_text),
r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY
        CASE WHEN split = 'train' THEN {md5_hash_sql('doc_id')} ELSE '' END, doc_id) - 1 AS position FROM s)
SELECT doc_id, split, position, position // 32 AS batch FROM r""", "labelled_text"))
def q_batch_assign(spark, sf_dir):
    lt = fx.labelled_text(spark, sf_dir).select("doc_id")
    s = sampling.split_three_way(lt, "doc_id", 0.8, 0.1, 0.1, SEED)
    return sampling.batch_assign(s, "doc_id", 32, SEED).select("doc_id", "split", "position", "batch")


@register("grad_accum_steps", fx.with_views(f"""
WITH e AS (SELECT run_id, epoch, count(*) AS micro_batches FROM train_log GROUP BY run_id, epoch)
SELECT run_id, epoch, micro_batches, CAST(micro_batches // {ACCUM} AS BIGINT) AS steps_taken,
       micro_batches % {ACCUM} AS trailing_micro,
       CAST(ceil(micro_batches / {ACCUM}) AS BIGINT) AS planned_steps,
       CAST(sum(micro_batches // {ACCUM}) OVER (PARTITION BY run_id ORDER BY epoch) AS BIGINT) AS global_step_end,
       CAST(sum(CAST(ceil(micro_batches / {ACCUM}) AS BIGINT)) OVER (PARTITION BY run_id ORDER BY epoch) AS BIGINT)
           AS planned_step_end
FROM e""", "train_log"))
def q_grad_accum(spark, sf_dir):
    return sampling.grad_accum_steps(fx.train_log(spark, sf_dir), ACCUM)

# ------------------------------------------------------------- T2, T3 (documents)


SQL_DOC_VOCAB = f"""
dtok AS (SELECT doc_id, {split_sql('doc_id')} AS split,
                regexp_extract_all(lower(text), '({WORD}+)', 1) AS t FROM documents),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + 3 AS INTEGER) AS id, freq
          FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(t) AS token FROM dtok WHERE split = 'train')
                GROUP BY token))"""


def doc_vocab(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    # texts stay in the splits of the scan: counts are combined there, and
    # the lookup works row by row
    toks = sampling.split_two_way(d, "doc_id", 0.1, SEED).select("doc_id", "split", word_tokens("text").alias("tokens"))
    train_tokens = toks.filter(F.col("split") == "train").select(
        F.explode_outer("tokens").alias("token")).filter(F.col("token").isNotNull())
    return toks, sq.build_vocab(train_tokens)


@register("build_vocab", f"""
WITH {SQL_DOC_VOCAB}
SELECT token, id, freq FROM vocab
UNION ALL SELECT * FROM (VALUES ('<unk>', 0, NULL), ('<pad>', 1, NULL), ('<bos>', 2, NULL), ('<eos>', 3, NULL))
    v(token, id, freq)""")
def q_build_vocab(spark, sf_dir):
    return doc_vocab(spark, sf_dir)[1]


@register("vocab_lookup", f"""
WITH {SQL_DOC_VOCAB},
ex AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM dtok),
ids AS (SELECT doc_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM ex LEFT JOIN vocab v USING (token)
        GROUP BY doc_id),
j AS (SELECT d.doc_id, coalesce(i.ids, []::INTEGER[]) AS ids FROM dtok d LEFT JOIN ids i USING (doc_id))
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens,
       CAST(len(list_filter(ids, lambda x: x = 0)) AS INTEGER) AS n_unk,
       md5(array_to_string(ids, ' ')) AS ids_md5 FROM j""")
def q_vocab_lookup(spark, sf_dir):
    toks, vocab = doc_vocab(spark, sf_dir)
    ids = sq.lookup_ids(toks, "doc_id", "tokens", vocab, keep=["doc_id"])
    return ids.select("doc_id", F.size("ids").alias("n_tokens"),
                      F.size(F.filter("ids", lambda x: x == 0)).alias("n_unk"),
                      ids_md5(F.col("ids")).alias("ids_md5"))

# ------------------------------------------------------------- pairs: T4, T5, T7-T11


SQL_PAIR_VOCAB = f"""
ptok AS (SELECT pair_id, {split_sql('pair_id')} AS split,
                regexp_extract_all(lower(prediction), '({WORD}+)', 1) AS src,
                regexp_extract_all(lower(reference), '({WORD}+)', 1) AS tgt FROM pairs),
pvocab AS (SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + 3 AS INTEGER) AS id, freq
           FROM (SELECT token, count(*) AS freq FROM
                 (SELECT unnest(src) AS token FROM ptok WHERE split = 'train'
                  UNION ALL SELECT unnest(tgt) AS token FROM ptok WHERE split = 'train')
                 GROUP BY token)),
tex AS (SELECT pair_id, unnest(tgt) AS token, unnest(range(len(tgt))) AS pos FROM ptok),
tids AS (SELECT p.pair_id, p.split, coalesce(i.ids, []::INTEGER[]) AS ids FROM ptok p LEFT JOIN
         (SELECT pair_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM tex LEFT JOIN pvocab v USING (token)
          GROUP BY pair_id) i USING (pair_id)),
enc AS (SELECT pair_id, split, list_concat([2], ids[1:{SEQ_LEN - 2}], [3]) AS w FROM tids),
bat AS (SELECT pair_id, split, w, (row_number() OVER (PARTITION BY split ORDER BY
          CASE WHEN split = 'train' THEN {md5_hash_sql('pair_id')} ELSE '' END, pair_id) - 1) // {BATCH} AS batch
        FROM enc),
padded AS (SELECT pair_id, split, batch, w,
                  list_resize(w, max(len(w)) OVER (PARTITION BY split, batch), 1) AS ids FROM bat)"""


def pair_tokens(spark, sf_dir):
    p = fx.pairs(spark, sf_dir)
    p = sampling.split_two_way(p, "pair_id", 0.1, SEED)
    toks = p.select("pair_id", "split", word_tokens("prediction").alias("src"),
                    word_tokens("reference").alias("tgt")).persist(StorageLevel.MEMORY_AND_DISK)
    train = toks.filter(F.col("split") == "train")
    occ = train.select(F.explode_outer("src").alias("token")).unionByName(
        train.select(F.explode_outer("tgt").alias("token"))).filter(F.col("token").isNotNull())
    return toks, sq.build_vocab(occ)


def padded_targets(spark, sf_dir):
    toks, vocab = pair_tokens(spark, sf_dir)
    ids = sq.lookup_ids(toks, "pair_id", "tgt", vocab, most=SEQ_LEN, keep=["pair_id", "split"])
    enc = ids.select("pair_id", "split", sq.wrap_truncate(F.col("ids"), SEQ_LEN).alias("w"))
    bat = sampling.batch_assign(enc, "pair_id", BATCH, SEED)
    longest = F.max(F.size("w")).over(Window.partitionBy("split", "batch"))
    return bat.withColumn("ids", sq.pad_to(F.col("w"), longest)), vocab


@register("encode_seq", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}
SELECT pair_id, split, batch, CAST(len(w) AS INTEGER) AS n_ids, CAST(len(ids) AS INTEGER) AS padded_len,
       md5(array_to_string(ids, ' ')) AS ids_md5 FROM padded""", "pairs"))
def q_encode_seq(spark, sf_dir):
    p, _ = padded_targets(spark, sf_dir)
    return p.select("pair_id", "split", "batch", F.size("w").alias("n_ids"),
                    F.size("ids").alias("padded_len"), ids_md5(F.col("ids")).alias("ids_md5"))


@register("collate_batches", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}
SELECT split, batch, count(*) AS n_rows, CAST(max(len(ids)) AS INTEGER) AS padded_len,
       md5(string_agg(array_to_string(ids[1:len(ids) - 1], ' '), '|' ORDER BY pair_id)) AS inputs_md5,
       md5(string_agg(array_to_string(ids[2:len(ids)], ' '), '|' ORDER BY pair_id)) AS labels_md5
FROM padded GROUP BY split, batch""", "pairs"))
def q_collate_batches(spark, sf_dir):
    """Unpadded sequences in their D7 batches, padded and stacked batch
    by batch by a user function."""
    toks, vocab = pair_tokens(spark, sf_dir)
    ids = sq.lookup_ids(toks, "pair_id", "tgt", vocab, most=SEQ_LEN, keep=["pair_id", "split"])
    enc = ids.select("pair_id", "split", sq.wrap_truncate(F.col("ids"), SEQ_LEN).alias("ids"))
    rows = sampling.batch_assign(enc, "pair_id", BATCH, SEED).select("split", "batch", "pair_id", "ids")
    stacked = scoring.collate_batches(
        rows, scoring.pad_and_stack("ids", "pair_id", sq.PAD),
        "split string, batch long, n_rows long, padded_len int, inputs array<array<int>>, labels array<array<int>>",
        ["split", "batch"])

    def digest(c: str):
        return F.md5(F.array_join(F.transform(c, lambda r: F.array_join(r, " ")), "|"))

    return stacked.select("split", "batch", "n_rows", "padded_len", digest("inputs").alias("inputs_md5"), digest("labels").alias("labels_md5"))


@register("teacher_forcing", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}
SELECT pair_id, md5(array_to_string(ids[1:len(ids) - 1], ' ')) AS input_md5,
       md5(array_to_string(ids[2:len(ids)], ' ')) AS labels_md5,
       CAST(len(ids) - 1 AS INTEGER) AS n_positions FROM padded""", "pairs"))
def q_teacher_forcing(spark, sf_dir):
    p, _ = padded_targets(spark, sf_dir)
    inp, lab = sq.teacher_forcing(F.col("ids"))
    return p.select("pair_id", ids_md5(inp).alias("input_md5"), ids_md5(lab).alias("labels_md5"),
                    (F.size("ids") - 1).alias("n_positions"))


@register("decode_seq", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB},
cut AS (SELECT pair_id, CASE WHEN coalesce(list_position(ids, 3), 0) > 0
                             THEN ids[1:list_position(ids, 3) - 1] ELSE ids END AS c FROM padded),
ex AS (SELECT pair_id, unnest(c) AS id, unnest(range(len(c))) AS pos FROM cut),
txt AS (SELECT pair_id, replace(array_to_string(list(coalesce(v.token, '<unk>') ORDER BY pos), ' '), '▁', '') AS text
        FROM ex LEFT JOIN pvocab v USING (id) WHERE ex.id >= 4 GROUP BY pair_id)
SELECT c.pair_id, coalesce(t.text, '') AS text FROM cut c LEFT JOIN txt t USING (pair_id)""", "pairs"))
def q_decode_seq(spark, sf_dir):
    p, vocab = padded_targets(spark, sf_dir)
    return sq.decode(p.select("pair_id", "ids"), "pair_id", "ids", vocab).select("pair_id", "text")


SQL_INSTR = f"""
itok AS (SELECT i.pair_id,
                regexp_extract_all(lower(CASE WHEN coalesce(input, '') <> ''
                    THEN 'Input: ' || input || chr(10) || 'Instruction: ' || instruction
                    ELSE 'Instruction: ' || instruction END), '({WORD}+)', 1) AS pt,
                regexp_extract_all(lower(output), '({WORD}+)', 1) AS yt FROM instructions i),
pex AS (SELECT pair_id, unnest(pt) AS token, unnest(range(len(pt))) AS pos FROM itok),
yex AS (SELECT pair_id, unnest(yt) AS token, unnest(range(len(yt))) AS pos FROM itok),
pids AS (SELECT pair_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM pex LEFT JOIN pvocab v USING (token)
         GROUP BY pair_id),
yids AS (SELECT pair_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM yex LEFT JOIN pvocab v USING (token)
         GROUP BY pair_id),
pyt AS (SELECT t.pair_id, coalesce(p.ids, []::INTEGER[]) AS p,
               list_concat(coalesce(y.ids, []::INTEGER[]), [3]) AS y
        FROM itok t LEFT JOIN pids p USING (pair_id) LEFT JOIN yids y USING (pair_id)),
cutx AS (SELECT pair_id, p, y, len(p) + len(y) - {INSTR_LEN} AS cut FROM pyt),
trunc AS (SELECT pair_id,
                 CASE WHEN cut <= 0 THEN list_concat(p, y)
                      WHEN cut < len(y) THEN list_concat(p, y[cut + 1:])
                      ELSE list_concat(p, y)[-{INSTR_LEN}:] END AS ids,
                 CASE WHEN cut <= 0 THEN list_concat(list_resize([]::INTEGER[], len(p), -100), y)
                      WHEN cut < len(y) THEN list_concat(list_resize([]::INTEGER[], len(p), -100), y[cut + 1:])
                      ELSE list_concat(list_resize([]::INTEGER[], len(p), -100), y)[-{INSTR_LEN}:] END AS lab
          FROM cutx),
instr AS (SELECT pair_id, list_resize(ids, {INSTR_LEN}, 1) AS input_ids,
                 list_resize(list_resize([]::INTEGER[], len(ids), 1), {INSTR_LEN}, 0) AS attention_mask,
                 list_resize(lab, {INSTR_LEN}, -100) AS labels FROM trunc)"""


def encoded_instructions(spark, sf_dir):
    _, vocab = pair_tokens(spark, sf_dir)
    ins = fx.instructions(spark, sf_dir)
    t = ins.select("pair_id", word_tokens(prompts.instruction_prompt("instruction", "input")).alias("pt"),
                   word_tokens("output").alias("yt"))
    t = sq.lookup_ids(t, "pair_id", {"pt": "p", "yt": "y"}, vocab, keep=["pair_id"])
    return sq.encode_instruction(t, "p", "y", INSTR_LEN)


@register("encode_instruction", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}, {SQL_INSTR}
SELECT pair_id, CAST(list_sum(attention_mask) AS BIGINT) AS n_real, md5(array_to_string(input_ids, ' ')) AS ids_md5,
       md5(array_to_string(labels, ' ')) AS labels_md5, CAST(len(input_ids) AS INTEGER) AS length FROM instr""",
                                               "pairs", "instructions"))
def q_encode_instruction(spark, sf_dir):
    e = encoded_instructions(spark, sf_dir)
    return e.select("pair_id", F.aggregate("attention_mask", F.lit(0).cast("long"),
                                           lambda a, x: a + x).alias("n_real"),
                    ids_md5(F.col("input_ids")).alias("ids_md5"), ids_md5(F.col("labels")).alias("labels_md5"),
                    F.size("input_ids").alias("length"))


@register("collator_labels", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}, {SQL_INSTR}
SELECT pair_id, md5(array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = 1 THEN -100 ELSE x END), ' '))
       AS labels_md5 FROM instr""", "pairs", "instructions"))
def q_collator_labels(spark, sf_dir):
    e = encoded_instructions(spark, sf_dir)
    return e.select("pair_id", ids_md5(sq.collator_labels(F.col("input_ids"))).alias("labels_md5"))


@register("valid_tokens", fx.with_views(f"""
WITH {SQL_PAIR_VOCAB}, {SQL_INSTR}
SELECT pair_id, CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS valid,
       md5(array_to_string(list_transform(labels, lambda x: CASE WHEN x = -100 THEN 1 ELSE x END), ' '))
       AS decode_ready_md5 FROM instr""", "pairs", "instructions"))
def q_valid_tokens(spark, sf_dir):
    e = encoded_instructions(spark, sf_dir)
    return e.select("pair_id", sq.valid_tokens(F.col("labels")).alias("valid"),
                    ids_md5(sq.ignored_to_pad(F.col("labels"))).alias("decode_ready_md5"))

# ------------------------------------------------------------- T6 (labelled documents)


@register("encode_fixed", fx.with_views(f"""
WITH {SQL_DOC_VOCAB},
lt AS (SELECT d.* FROM dtok d JOIN labelled_text l USING (doc_id)),
ex AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM lt),
ids AS (SELECT doc_id, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM ex LEFT JOIN vocab v USING (token)
        GROUP BY doc_id),
j AS (SELECT l.doc_id, list_concat([2], coalesce(i.ids, []::INTEGER[])[1:{FIXED_LEN - 2}], [3]) AS core
      FROM lt l LEFT JOIN ids i USING (doc_id))
SELECT doc_id, CAST(len(core) AS INTEGER) AS n_real,
       md5(array_to_string(list_resize(core, {FIXED_LEN}, 1), ' ')) AS ids_md5,
       md5(array_to_string(list_resize([]::INTEGER[], {FIXED_LEN}, 0), ' ')) AS types_md5 FROM j""", "labelled_text"))
def q_encode_fixed(spark, sf_dir):
    toks, vocab = doc_vocab(spark, sf_dir)
    lt = fx.labelled_text(spark, sf_dir).select("doc_id")
    ids = sq.lookup_ids(toks.join(lt, "doc_id"), "doc_id", "tokens", vocab, most=FIXED_LEN, keep=["doc_id"])
    fixed, mask, types = sq.encode_fixed(F.col("ids"), FIXED_LEN)
    return ids.select("doc_id", F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("n_real"),
                      ids_md5(fixed).alias("ids_md5"), ids_md5(types).alias("types_md5"))

# ------------------------------------------------------------- P1 - P4


@register("project_lang", fx.with_views("""
SELECT pair_id, translation['en'] AS en, translation['cs'] AS cs FROM translation""", "translation"))
def q_project_lang(spark, sf_dir):
    t = fx.translation(spark, sf_dir)
    return t.select("pair_id", prompts.project_lang("translation", "en").alias("en"),
                    prompts.project_lang("translation", "cs").alias("cs"))


@register("prompt_instruction", fx.with_views("""
SELECT pair_id, CASE WHEN coalesce(input, '') <> '' THEN 'Input: ' || input || chr(10) || 'Instruction: ' || instruction
                     ELSE 'Instruction: ' || instruction END AS prompt FROM instructions""", "instructions"))
def q_prompt_instruction(spark, sf_dir):
    i = fx.instructions(spark, sf_dir)
    return i.select("pair_id", prompts.instruction_prompt("instruction", "input").alias("prompt"))


@register("prompt_zero_shot", f"""
SELECT item_id, 'Question: ' || text || chr(10) || {sql_lit(prompts.STEP_CUE)} AS prompt FROM benchmark""")
def q_prompt_zero_shot(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return b.select("item_id", prompts.zero_shot_prompt("text").alias("prompt"))


@register("prompt_few_shot", f"""
SELECT item_id, {sql_lit(prompts.few_shot_prefix() + 'Q: ')} || text || {sql_lit(chr(10) + 'A: ' + prompts.STEP_CUE + chr(10))}
       AS prompt FROM benchmark""")
def q_prompt_few_shot(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return b.select("item_id", prompts.few_shot_prompt("text").alias("prompt"))
