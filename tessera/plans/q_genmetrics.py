"""Queries: text-generation metrics over ``pairs`` (A9-A16) and
embedding matching over ``token_vectors`` (A15)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tessera.functions.stems import sql_stem
from tessera.functions.text import WORD, WS, _13A_PUNCT
from tessera.operators import bootstrap as bs
from tessera.operators import clfmetrics as cm
from tessera.operators import genmetrics as gm
from tessera.operators.shifts import translation_edit_rate
from tessera.operators.vectors import greedy_match_f1
from tessera.plans import fixtures as fx
from tessera.plans.q_runs import CE_SQL
from tessera.plans.registry import R6, r6, register

# ------------------------------------------------------------- SQL helpers


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_split(x: str) -> str:
    s = sql_strip(x)
    return f"CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, '{WS}+') END"


def sql_13a(x: str) -> str:
    s = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = f"replace({s}, '{a}', '{b}')"
    s = f"(' ' || {s} || ' ')"
    s = f"regexp_replace({s}, '{_13A_PUNCT}', ' \\1 ', 'g')"
    s = f"regexp_replace({s}, '([^0-9])([\\.,])', '\\1 \\2 ', 'g')"
    s = f"regexp_replace({s}, '([\\.,])([^0-9])', ' \\1 \\2', 'g')"
    s = f"regexp_replace({s}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return sql_split(s)


def sql_rouge_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '([a-z0-9]+)', 1)"


METEOR_RE = f"({WORD}+|[^\\p{{L}}\\p{{N}}_{WS[1:-1]}])"


def sql_ngram_stats(tk: str, orders, chars: bool = False) -> str:
    """CTEs ``g``/``st`` from ``tk(pair_id, h, r)``: per (pair, n) matches and totals."""
    sel = []
    for n in orders:
        for side, c in ((0, "h"), (1, "r")):
            if chars:
                expr = f"list_transform(range(1, length({c}) - {n} + 2), lambda i: substr({c}, i, {n}))"
            elif n == 1:
                expr = c
            else:
                expr = f"list_transform(range(0, len({c}) - {n} + 1), lambda i: array_to_string({c}[i + 1:i + {n}], ' '))"
            sel.append(f"SELECT pair_id, {n} AS n, unnest({expr}) AS gram, {side} AS side FROM {tk}")
    union = "\n UNION ALL ".join(sel)
    return f"""g AS ({union}),
pg AS (SELECT pair_id, n, gram, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS hc,
              sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS rc FROM g GROUP BY pair_id, n, gram),
st AS (SELECT pair_id, n, sum(least(hc, rc)) AS matches, sum(hc) AS hyp_total, sum(rc) AS ref_total
       FROM pg GROUP BY pair_id, n)"""


def _bleu_sql() -> str:
    ps, zeros = [], "0"
    for n in range(1, 5):
        m, t = f"coalesce(m{n}, 0)", f"coalesce(t{n}, 0)"
        here = f"({zeros} + CASE WHEN {m} = 0 THEN 1 ELSE 0 END)"
        ps.append(f"CASE WHEN {t} = 0 THEN 0.0 WHEN {m} = 0 THEN 100.0 / (pow(2.0, {here}) * {t}) "
                  f"ELSE 100.0 * {m} / {t} END AS p{n}")
        zeros = here
    logs = " + ".join(f"CASE WHEN p{n} > 0 THEN ln(p{n}) ELSE {gm.LOG_ZERO} END" for n in range(1, 5))
    piv = ", ".join(f"sum(CASE WHEN n = {n} THEN matches END) AS m{n}, sum(CASE WHEN n = {n} THEN hyp_total END) AS t{n}"
                    for n in range(1, 5))
    return f"""WITH tk AS (SELECT pair_id, {sql_13a('prediction')} AS h, {sql_13a('reference')} AS r FROM pairs),
{sql_ngram_stats('tk', range(1, 5))},
w AS (SELECT {piv}, sum(CASE WHEN n = 1 THEN ref_total END) AS r1 FROM st),
pp AS (SELECT {', '.join(ps)}, coalesce(m1, 0) + coalesce(m2, 0) + coalesce(m3, 0) + coalesce(m4, 0) AS any_m,
              CAST(coalesce(t1, 0) AS BIGINT) AS sys_len, CAST(coalesce(r1, 0) AS BIGINT) AS ref_len FROM w),
bb AS (SELECT *, CASE WHEN sys_len < ref_len THEN CASE WHEN sys_len > 0 THEN exp(1 - ref_len / sys_len) ELSE 0.0 END
                      ELSE 1.0 END AS bp FROM pp)
SELECT {R6(f'CASE WHEN any_m = 0 THEN 0.0 ELSE bp * exp(({logs}) / 4) END')} AS bleu, {R6('bp')} AS bp,
       sys_len, ref_len, {', '.join(R6(f'p{n}') + f' AS p{n}' for n in range(1, 5))} FROM bb"""


def _chrf_sql() -> str:
    nows = lambda c: f"regexp_replace({c}, '{WS}', '', 'g')"
    return f"""WITH tk AS (SELECT pair_id, {nows('prediction')} AS h, {nows('reference')} AS r FROM pairs),
{sql_ngram_stats('tk', range(1, 7), chars=True)},
tot AS (SELECT n, sum(matches) AS m, sum(hyp_total) AS h, sum(ref_total) AS r FROM st GROUP BY n),
a AS (SELECT sum(CASE WHEN h > 0 AND r > 0 THEN m / h END) AS sp, sum(CASE WHEN h > 0 AND r > 0 THEN m / r END) AS sr,
             sum(CASE WHEN h > 0 AND r > 0 THEN 1 ELSE 0 END) AS k FROM tot),
pr AS (SELECT coalesce(sp / k, 0.0) AS p, coalesce(sr / k, 0.0) AS r FROM a)
SELECT {R6('CASE WHEN p + r > 0 THEN 100.0 * 5.0 * p * r / (4.0 * p + r) ELSE 0.0 END')} AS chrf,
       {R6('p')} AS char_precision, {R6('r')} AS char_recall FROM pr"""


ROUGE_N_SQL = f"""WITH tk AS (SELECT pair_id, {sql_rouge_tokens('prediction')} AS h, {sql_rouge_tokens('reference')} AS r
            FROM pairs),
{sql_ngram_stats('tk', (1, 2))},
f AS (SELECT pair_id, n, matches / greatest(hyp_total, 1) AS p, matches / greatest(ref_total, 1) AS r FROM st),
ff AS (SELECT pair_id, n, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM f)
SELECT p.pair_id, {R6('coalesce(max(CASE WHEN n = 1 THEN f END), 0.0)')} AS rouge1,
       {R6('coalesce(max(CASE WHEN n = 2 THEN f END), 0.0)')} AS rouge2
FROM pairs p LEFT JOIN ff USING (pair_id) GROUP BY p.pair_id"""

METEOR_TAIL = f"""b AS (SELECT pair_id, CASE WHEN lag(hp) OVER w = hp - 1 AND lag(rp) OVER w = rp - 1 THEN 0 ELSE 1 END AS b
      FROM m WINDOW w AS (PARTITION BY pair_id ORDER BY hp)),
per AS (SELECT pair_id, count(*) AS matches, sum(b) AS chunks FROM b GROUP BY pair_id),
j AS (SELECT tk.pair_id, len(h) AS lh, len(r) AS lr, coalesce(matches, 0) AS matches,
             CAST(coalesce(chunks, 0) AS BIGINT) AS chunks FROM tk LEFT JOIN per USING (pair_id))
SELECT pair_id, matches, chunks,
       {R6('CASE WHEN matches = 0 OR lh = 0 OR lr = 0 THEN 0.0 ELSE (1 - 0.5 * pow(chunks / matches, 3.0)) * ((matches / lh) * (matches / lr) / (0.9 * (matches / lh) + 0.1 * (matches / lr))) END')} AS meteor
FROM j"""

METEOR_SQL = f"""WITH tk AS (SELECT pair_id, regexp_extract_all(lower(prediction), '{METEOR_RE}', 1) AS h,
                   regexp_extract_all(lower(reference), '{METEOR_RE}', 1) AS r FROM pairs),
he AS (SELECT pair_id, unnest(h) AS tok, unnest(range(len(h))) AS hp FROM tk),
re AS (SELECT pair_id, unnest(r) AS tok, unnest(range(len(r))) AS rp FROM tk),
hk AS (SELECT *, row_number() OVER (PARTITION BY pair_id, tok ORDER BY hp DESC) AS k FROM he),
rk AS (SELECT *, row_number() OVER (PARTITION BY pair_id, tok ORDER BY rp DESC) AS k FROM re),
m AS (SELECT hk.pair_id, hp, rp FROM hk JOIN rk ON hk.pair_id = rk.pair_id AND hk.tok = rk.tok AND hk.k = rk.k),
{METEOR_TAIL}"""


METEOR_STEM_SQL = f"""WITH tk AS (SELECT pair_id, regexp_extract_all(lower(prediction), '{METEOR_RE}', 1) AS h,
                   regexp_extract_all(lower(reference), '{METEOR_RE}', 1) AS r FROM pairs),
words AS (SELECT DISTINCT unnest(list_concat(h, r)) AS tok FROM tk),
stems AS (SELECT tok, {sql_stem('tok')} AS stem FROM words),
he AS (SELECT pair_id, unnest(h) AS tok, unnest(range(len(h))) AS hp FROM tk),
re AS (SELECT pair_id, unnest(r) AS tok, unnest(range(len(r))) AS rp FROM tk),
hk AS (SELECT *, row_number() OVER (PARTITION BY pair_id, tok ORDER BY hp DESC) AS k FROM he),
rk AS (SELECT *, row_number() OVER (PARTITION BY pair_id, tok ORDER BY rp DESC) AS k FROM re),
x AS (SELECT hk.pair_id, hp, rp FROM hk JOIN rk ON hk.pair_id = rk.pair_id AND hk.tok = rk.tok AND hk.k = rk.k),
hs AS (SELECT he.pair_id, hp, stem, row_number() OVER (PARTITION BY he.pair_id, stem ORDER BY hp DESC) AS k
       FROM he JOIN stems USING (tok) ANTI JOIN x USING (pair_id, hp)),
rs AS (SELECT re.pair_id, rp, stem, row_number() OVER (PARTITION BY re.pair_id, stem ORDER BY rp DESC) AS k
       FROM re JOIN stems USING (tok) ANTI JOIN x USING (pair_id, rp)),
m AS (SELECT * FROM x UNION ALL SELECT pair_id, hp, rp FROM hs JOIN rs USING (pair_id, stem, k)),
{METEOR_TAIL}"""

ROUGE_STEM_SQL = ROUGE_N_SQL.replace("WITH tk AS (", "WITH raw AS (", 1).replace(
    "FROM pairs),", f"""FROM pairs),
stems AS (SELECT tok, CASE WHEN length(tok) > 3 THEN {sql_stem('tok')} ELSE tok END AS stem
          FROM (SELECT DISTINCT unnest(list_concat(h, r)) AS tok FROM raw)),
sh AS (SELECT pair_id, list(stem ORDER BY i) AS h FROM (SELECT pair_id, unnest(h) AS tok, generate_subscripts(h, 1) AS i FROM raw)
       JOIN stems USING (tok) GROUP BY pair_id),
sr AS (SELECT pair_id, list(stem ORDER BY i) AS r FROM (SELECT pair_id, unnest(r) AS tok, generate_subscripts(r, 1) AS i FROM raw)
       JOIN stems USING (tok) GROUP BY pair_id),
tk AS (SELECT pair_id, coalesce(sh.h, []) AS h, coalesce(sr.r, []) AS r FROM raw LEFT JOIN sh USING (pair_id) LEFT JOIN sr USING (pair_id)),""", 1)


@register("bleu", fx.with_views(_bleu_sql(), "pairs"))
def q_bleu(spark, sf_dir):
    b = gm.bleu(fx.pairs(spark, sf_dir))
    return b.select(r6("bleu").alias("bleu"), r6("bp").alias("bp"), "sys_len", "ref_len",
                    *[r6(f"p{n}").alias(f"p{n}") for n in range(1, 5)])


@register("chrf", fx.with_views(_chrf_sql(), "pairs"))
def q_chrf(spark, sf_dir):
    c = gm.chrf(fx.pairs(spark, sf_dir))
    return c.select(*[r6(x).alias(x) for x in ("chrf", "char_precision", "char_recall")])


@register("rouge_n", fx.with_views(ROUGE_N_SQL, "pairs"))
def q_rouge_n(spark, sf_dir):
    r = gm.rouge_n(fx.pairs(spark, sf_dir))
    return r.select("pair_id", r6("rouge1").alias("rouge1"), r6("rouge2").alias("rouge2"))


@register("rouge_n_stemmed", fx.with_views(ROUGE_STEM_SQL, "pairs"))
def q_rouge_stemmed(spark, sf_dir):
    """A11 on stems, as the translation evaluation uses it."""
    r = gm.rouge_n(fx.pairs(spark, sf_dir), stem=True)
    return r.select("pair_id", r6("rouge1").alias("rouge1"), r6("rouge2").alias("rouge2"))


REPLICATES = 400
BOOTSTRAP_SQL = f"""WITH per AS ({ROUGE_STEM_SQL.replace("1e6", "1e12")}),
hs AS (SELECT pair_id, rouge1, rouge2, k, md5('42:' || pair_id || ':' || k) AS d FROM per, (SELECT unnest(range({REPLICATES // 8})) AS k)),
u AS (SELECT rouge1, rouge2, k * 8 + i AS replicate, ('0x' || substr(d, CAST(4 * i + 1 AS INTEGER), 4))::INTEGER AS u
      FROM hs, (SELECT unnest(range(8)) AS i)),
c AS (SELECT *, {" + ".join(f"(u >= {t})::INTEGER" for t in bs.THRESHOLDS)} AS c FROM u),
means AS (SELECT replicate, sum(c * rouge1) / sum(c) AS rouge1, sum(c * rouge2) / sum(c) AS rouge2 FROM c GROUP BY replicate),
l AS (SELECT 'rouge1' AS measure, rouge1 AS x FROM means UNION ALL SELECT 'rouge2', rouge2 FROM means)
SELECT measure, {", ".join(f"{R6(f'quantile_cont(x, {q})')} AS {n}" for n, q in (("low", 0.025), ("mid", 0.5), ("high", 0.975)))}
FROM l GROUP BY measure"""


@register("rouge_bootstrap", fx.with_views(BOOTSTRAP_SQL, "pairs"))
def q_rouge_bootstrap(spark, sf_dir):
    """Resampled median and 95 % bounds of the mean scores."""
    per = gm.rouge_n(fx.pairs(spark, sf_dir), stem=True)
    b = bs.interval(per, "pair_id", ["rouge1", "rouge2"], REPLICATES, seed=42)
    return b.select("measure", *[r6(c).alias(c) for c in ("low", "mid", "high")])


@register("ter_shifts")
def q_ter_shifts(spark, sf_dir):
    """A14 with block shifts."""
    t = translation_edit_rate(fx.pairs(spark, sf_dir))
    return t.select("shifts", "edits", "ref_words", r6("ter").alias("ter"))


@register("meteor_stemmed", fx.with_views(METEOR_STEM_SQL, "pairs"))
def q_meteor_stemmed(spark, sf_dir):
    """A13 with the stem stage."""
    m = gm.meteor_stemmed(fx.pairs(spark, sf_dir))
    return m.select("pair_id", "matches", "chunks", r6("meteor").alias("meteor"))


@register("meteor_exact", fx.with_views(METEOR_SQL, "pairs"))
def q_meteor(spark, sf_dir):
    m = gm.meteor_exact(fx.pairs(spark, sf_dir))
    return m.select("pair_id", "matches", "chunks", r6("meteor").alias("meteor"))


def _lcs_row(acc: str, x: str) -> str:
    """SQL of the next row of LCS lengths: ``acc`` the last one, ``x`` 1
    where the reference token equals the new hypothesis token."""
    best = f"greatest({acc}[k], CASE WHEN {x}[k] = 1 THEN coalesce({acc}[k - 1], 0) + 1 ELSE 0 END)"
    return (f"list_transform(range(1, len({x}) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: {best})))")


def _hits(h: str, r: str) -> str:
    """SQL list: for each token of ``h`` the 0/1 list of equal ``r`` tokens."""
    return f"list_transform({h}, lambda a: list_transform({r}, lambda b: CASE WHEN a = b THEN 1 ELSE 0 END))"


ROUGE_L_SQL = f"""WITH tk AS (SELECT pair_id, {sql_rouge_tokens('prediction')} AS h, {sql_rouge_tokens('reference')} AS r FROM pairs),
l AS (SELECT pair_id, len(h) AS lh, len(r) AS lr, CASE WHEN len(h) = 0 OR len(r) = 0 THEN 0 ELSE
        list_reduce({_hits('h', 'r')}, lambda acc, x: {_lcs_row('acc', 'x')}, list_transform(r, lambda b: 0))[-1] END AS n FROM tk)
SELECT pair_id, {R6('CASE WHEN n = 0 THEN 0.0 ELSE 2 * (n / lh) * (n / lr) / (n / lh + n / lr) END')} AS "rougeL" FROM l"""

# Lsum: rows of lengths for every sentence pair, then a walk over the columns
# from the last: state = open prefix of the reference, then the positions taken.
_TOP = ("coalesce(list_max(list_filter(range(1, acc[1][1] + 1), lambda k: x[2][k] = 1 "
        "OR x[1][k] > coalesce(x[1][k - 1], 0))), 0)")
_WALK = (f"CASE WHEN {_TOP} = 0 THEN [[0], acc[2]] WHEN x[2][{_TOP}] = 1 THEN [[{_TOP} - 1], list_append(acc[2], {_TOP})] "
         f"ELSE [[{_TOP}], acc[2]] END")
ROUGE_LSUM_SQL = f"""WITH s AS (SELECT pair_id,
         list_filter(list_transform(string_split(prediction, chr(10)), lambda t: {sql_rouge_tokens('t')}), lambda t: len(t) > 0) AS hs,
         list_filter(list_transform(string_split(reference, chr(10)), lambda t: {sql_rouge_tokens('t')}), lambda t: len(t) > 0) AS rs
       FROM pairs),
ri AS (SELECT pair_id, hs, unnest(rs) AS r, unnest(range(len(rs))) AS ri FROM s),
c AS (SELECT pair_id, ri, r, unnest(hs) AS h FROM ri),
e AS (SELECT pair_id, ri, r, {_hits('h', 'r')} AS hit FROM c),
rows AS (SELECT pair_id, ri, r, hit, list_reduce(list_transform(hit, lambda x: [x]),
           lambda acc, x: list_append(acc, {_lcs_row('(acc[-1])', '(x[1])')}), [list_transform(r, lambda b: 0)])[2:] AS lens FROM e),
w AS (SELECT pair_id, ri, r, list_reduce(list_reverse(list_transform(range(1, len(hit) + 1), lambda i: [lens[i], hit[i]])),
           lambda acc, x: {_WALK}, [[len(r)], []::INTEGER[]])[2] AS taken FROM rows),
u AS (SELECT DISTINCT pair_id, ri, unnest(taken) AS pos, r FROM w),
al AS (SELECT pair_id, r[pos] AS tok, count(*) AS n FROM u GROUP BY ALL),
ht AS (SELECT pair_id, unnest(flatten(hs)) AS tok FROM s),
hc AS (SELECT pair_id, tok, count(*) AS n FROM ht GROUP BY ALL),
k AS (SELECT pair_id, sum(least(al.n, hc.n)) AS hits FROM al JOIN hc USING (pair_id, tok) GROUP BY pair_id),
f AS (SELECT s.pair_id, coalesce(hits, 0) AS x, len(flatten(hs)) AS lh, len(flatten(rs)) AS lr FROM s LEFT JOIN k USING (pair_id))
SELECT pair_id, {R6('CASE WHEN x = 0 THEN 0.0 ELSE 2 * (x / lh) * (x / lr) / (x / lh + x / lr) END')} AS "rougeLsum" FROM f"""

_STEP = ("list_transform(range(1, len(acc) + 1), lambda j: CASE WHEN j = 1 THEN acc[1] + 1 "
         "ELSE least(acc[j] + 1, acc[j - 1] + 1 - x[j]) END)")
WER_SQL = f"""WITH tk AS (SELECT pair_id, {sql_split('lower(prediction)')} AS h, {sql_split('lower(reference)')} AS r FROM pairs),
e AS (SELECT len(r) AS lr, list_reduce(list_transform({_hits('h', 'r')}, lambda x: list_prepend(0, x)),
        lambda acc, x: list_transform(range(1, len(acc) + 1), lambda j: list_min(list_transform({_STEP}[1:j], lambda t, k: t + j - k))),
        range(0, len(r) + 1)::INTEGER[])[-1] AS edits FROM tk)
SELECT sum(edits)::BIGINT AS edits, sum(lr)::BIGINT AS ref_words, {R6('100.0 * sum(edits) / greatest(sum(lr), 1)')} AS wer FROM e"""


@register("rouge_l", fx.with_views(ROUGE_L_SQL, "pairs"))
def q_rouge_l(spark, sf_dir):
    r = gm.rouge_l(fx.pairs(spark, sf_dir))
    return r.select("pair_id", r6("rougeL").alias("rougeL"))


@register("rouge_lsum", fx.with_views(ROUGE_LSUM_SQL, "pairs"))
def q_rouge_lsum(spark, sf_dir):
    r = gm.rouge_l(fx.pairs(spark, sf_dir))
    return r.select("pair_id", r6("rougeLsum").alias("rougeLsum"))


@register("word_error_rate", fx.with_views(WER_SQL, "pairs"))
def q_wer(spark, sf_dir):
    w = gm.word_error_rate(fx.pairs(spark, sf_dir))
    return w.select("edits", "ref_words", r6("wer").alias("wer"))


GREEDY_SQL = f"""WITH c AS (SELECT a.pair_id, a.side AS aside, a.pos AS apos,
                  list_cosine_similarity(a.vec, b.vec) AS cs
           FROM token_vectors a JOIN token_vectors b ON a.pair_id = b.pair_id AND a.side <> b.side),
mx AS (SELECT pair_id, aside, apos, max(cs) AS best FROM c GROUP BY pair_id, aside, apos),
pr AS (SELECT pair_id, avg(CASE WHEN aside = 0 THEN best END) AS p, avg(CASE WHEN aside = 1 THEN best END) AS r
       FROM (SELECT * FROM mx UNION ALL SELECT DISTINCT pair_id, s.side, NULL, 0.0 FROM token_vectors, (VALUES (0), (1)) s(side)
             WHERE pair_id NOT IN (SELECT pair_id FROM mx)) GROUP BY pair_id)
SELECT pair_id, {R6('p')} AS precision, {R6('r')} AS recall,
       {R6('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END')} AS f1 FROM pr"""


@register("greedy_match_f1", fx.with_views(GREEDY_SQL, "token_vectors"))
def q_greedy(spark, sf_dir):
    g = greedy_match_f1(fx.token_vectors(spark, sf_dir))
    return g.select("pair_id", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


def _mean(sql: str, column: str) -> str:
    # twelve places instead of six inside, so that only the mean is rounded
    return f'(SELECT avg("{column}") FROM ({sql.replace("1e6", "1e12")}) q)'


REPORT_SQL = "SELECT " + ", ".join(f"{R6(x)} AS \"{k}\"" for k, x in {
    "test_loss": _mean(CE_SQL, "ce"), "bleu": _mean(_bleu_sql(), "bleu"), "chrf": _mean(_chrf_sql(), "chrf"),
    "rouge1": _mean(ROUGE_N_SQL, "rouge1"), "rouge2": _mean(ROUGE_N_SQL, "rouge2"), "rougeL": _mean(ROUGE_L_SQL, "rougeL"),
    "rougeLsum": _mean(ROUGE_LSUM_SQL, "rougeLsum"), "meteor": _mean(METEOR_SQL, "meteor"), "ter": _mean(WER_SQL, "wer"),
    "bertscore_f1": _mean(GREEDY_SQL, "f1")}.items())


@register("generation_report", fx.with_views(REPORT_SQL, "pairs", "logits", "token_vectors"))
def q_generation_report(spark, sf_dir):
    """One row with every metric; each metric is a one-row result
    read as a scalar subquery (no cross join)."""
    # the pair table feeds every metric: build it once and keep it
    p = fx.pairs(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    ce = cm.cross_entropy(fx.logits(spark, sf_dir)).agg(F.avg("ce"))
    rn = gm.rouge_n(p).agg(F.struct(F.avg("rouge1").alias("a"), F.avg("rouge2").alias("b"))).scalar()
    rl = gm.rouge_l(p).agg(F.struct(F.avg("rougeL").alias("a"), F.avg("rougeLsum").alias("b"))).scalar()
    parts = {
        "test_loss": ce.scalar(),
        "bleu": gm.bleu(p).select("bleu").scalar(),
        "chrf": gm.chrf(p).select("chrf").scalar(),
        "rouge1": rn["a"],
        "rouge2": rn["b"],
        "rougeL": rl["a"],
        "rougeLsum": rl["b"],
        "meteor": gm.meteor_exact(p).agg(F.avg("meteor")).scalar(),
        "ter": gm.word_error_rate(p).select("wer").scalar(),
        "bertscore_f1": greedy_match_f1(fx.token_vectors(spark, sf_dir)).agg(F.avg("f1")).scalar(),
    }
    return spark.range(1).select(*[r6(c).alias(k) for k, c in parts.items()])
