"""Registered queries of this subpackage: opN_<name> over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD, held_out, load, pick

#: Labelled documents at most that the quality machine is fitted on.
QUALITY_SAMPLE = 6000
#: Labelled documents at most that the toxicity field is fitted on.
TOXIC_SAMPLE = 6000
#: Documents of each language at most that the language field is fitted on.
LANGUAGE_SAMPLE = 600

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


@register("op9_byte_bpe")
def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tessera.llm import bpe

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = pick(load(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return bpe.encode(docs, path, pattern, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _cover(size: int) -> str:
    return (f"coalesce(max(k{size} is not null and n{size} > 1) over (partition by doc_id order by i "
            f"rows between {size - 1} preceding and current row), false)")


@register("op5_suffix_repetition", f"""
WITH d AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents),
w AS (SELECT doc_id, words, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
k AS (SELECT doc_id, i, length(w) AS c,
        CASE WHEN i + 4 <= len(words) THEN md5(array_to_string(words[i:i + 4], ' ')) END AS k5,
        CASE WHEN i + 9 <= len(words) THEN md5(array_to_string(words[i:i + 9], ' ')) END AS k10,
        CASE WHEN i + 100 <= len(words) THEN md5(array_to_string(words[i:i + 100], ' ')) END AS k101 FROM w),
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, k5) AS n5, count(*) OVER (PARTITION BY doc_id, k10) AS n10,
        count(*) OVER (PARTITION BY doc_id, k101) AS n101 FROM k),
c AS (SELECT doc_id, c, k101 IS NOT NULL AND n101 > 1 AS far, {_cover(5)} AS c5, {_cover(10)} AS c10 FROM n),
r AS (SELECT doc_id, count(*) AS n_words, sum(c) AS word_chars, count(*) FILTER (c5) AS n_repeat_words,
        coalesce(sum(c) FILTER (c10), 0) AS covered, bool_or(far) AS far FROM c GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
a AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(covered, 0) AS covered, coalesce(far, false) AS far
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN dup USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND covered <= 0.25 * word_chars AND NOT far AS kept FROM b""")
def q_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.repetition import repetition

    return repetition(load(spark, sf_dir, "documents")).drop("repeats", "longest_repeat", "covered_chars")


@register("op7_factorisation_machine")
def q_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import fm

    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    machine = fm.fit(fm.labelled_sample(docs, labels, "quality", lambda c: ~held_out(c), QUALITY_SAMPLE))
    return fm.score(docs, machine, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op3_systematic_mix", f"""
WITH r AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
             substr(md5(doc_id::VARCHAR), 1, 2) AS bucket FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
p AS (SELECT *, [3.0::DOUBLE, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
q AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM p),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
        - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM q),
t AS (SELECT source, source_size, least(cap, coalesce(max(level) FILTER (level <= ratio) OVER () * weight, cap)) AS target,
        ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 7))::BIGINT * 4 AS u FROM l),
e AS (SELECT r.doc_id, r.size, source_size, target, u, CASE WHEN source_size > 0
        THEN least(floor(target / source_size * 1073741824), 2147483648)::BIGINT ELSE 0 END AS unit,
        row_number() OVER (PARTITION BY r.source ORDER BY -floor(sqrt(r.size)), bucket, doc_id, size)::HUGEINT AS n
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (((u + n * unit) // 1073741824 - (u + (n - 1) * unit) // 1073741824) * size)::BIGINT AS taken FROM e""")
def q_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import mix_sources

    return mix_sources(load(spark, sf_dir, "documents"), ["doc_id"]).drop("copies")


@register("op10_difference_cover", f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents),
w AS (SELECT doc_id, words, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
k AS (SELECT doc_id, i, w, CASE WHEN i + 49 <= len(words) THEN md5(array_to_string(words[i:i + 49], ' ')) END AS k FROM w),
m AS (SELECT *, k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id AS later FROM k),
c AS (SELECT *, max(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
g AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)""")
def q_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.anchors import substring_dedup

    return substring_dedup(load(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op8_simhash_tiles")
def q_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import near_duplicates

    return near_duplicates(load(spark, sf_dir, "documents"), shingle=4, radius=4).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op4_crf_language")
def q_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import langid

    docs = load(spark, sf_dir, "documents")
    model = langid.fit(langid.sample(docs, lambda c: ~held_out(c), LANGUAGE_SAMPLE))
    return langid.identify(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register("op1_crf_toxicity")
def q_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import fm, toxicity

    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.fit(fm.labelled_sample(docs, labels, "toxic", lambda c: ~held_out(c), TOXIC_SAMPLE))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_toxic")


@register("op6_kd_shards")
def q_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.shards import shard_documents

    return shard_documents(load(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register("op2_projected_neighbours", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20""")
def q_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.neighbours import nearest

    return nearest(load(spark, sf_dir, "embeddings"), lambda c: c % 20 == 0, 20)


@register("op11_adaptive_prefix_join", f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        generate_series(1, greatest(len(w) - 2, 1)), lambda i: md5(array_to_string(w[i:i + 2], ' ')))) END AS shingles FROM d),
t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least(doc_id, b) AS component_id FROM s LEFT JOIN m ON doc_id = a""")
def q_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.prefixjoin import similar

    return similar(load(spark, sf_dir, "documents"), shingle=3, percent=90)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: crc32 of the decimal id, bit by bit.
_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), "
        "lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))")


@register("op12_postorder_manifest", f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
        CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS tampered FROM documents),
r AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS run,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS j, count(*) OVER (PARTITION BY lang) AS c FROM d),
t AS (SELECT run, 0 AS k, j, c, leaf AS h FROM r UNION ALL
      SELECT run, k + 1, j // 2, (c + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM t WHERE c > 1 GROUP BY run, k, j // 2, c),
s AS (SELECT run AS j, h, count(*) OVER () AS c FROM t WHERE c = 1),
u AS (SELECT 0 AS k, j, c, h FROM s UNION ALL
      SELECT k + 1, j // 2, (c + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM u WHERE c > 1 GROUP BY k, j // 2, c),
f AS (SELECT doc_id, leaf, run, 0 AS k, j, c, coalesce(tampered, leaf) AS h, '' AS p FROM r UNION ALL
      SELECT doc_id, leaf, f.run, f.k + 1, f.j // 2, (f.c + 1) // 2,
             sha256(CASE WHEN t.h IS NULL THEN f.h WHEN f.j % 2 = 0 THEN f.h || t.h ELSE t.h || f.h END), p || coalesce(t.h, '')
      FROM f LEFT JOIN t ON t.run = f.run AND t.k = f.k AND t.j = xor(f.j, 1) WHERE f.c > 1),
g AS (SELECT doc_id, leaf, f.run, 0 AS k, f.run AS j, s.c, f.h, p, s.h AS subroot FROM f JOIN s ON s.j = f.run WHERE f.c = 1 UNION ALL
      SELECT doc_id, leaf, run, g.k + 1, g.j // 2, (g.c + 1) // 2,
             sha256(CASE WHEN u.h IS NULL THEN g.h WHEN g.j % 2 = 0 THEN g.h || u.h ELSE u.h || g.h END), p || coalesce(u.h, ''), subroot
      FROM g LEFT JOIN u ON u.k = g.k AND u.j = xor(g.j, 1) WHERE g.c > 1)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(p) AS proof_sha256, g.h AS folded_root, g.h = u.h AS verified
FROM g, u WHERE g.c = 1 AND u.c = 1""")
def q_postorder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import merkle

    rows, _, _ = merkle.manifest(load(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"])
    return merkle.verify(rows).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", ""), 256).alias("proof_sha256"), "folded_root", "verified")


@register("op13_bounded_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
x AS (SELECT lang, phrase, a, k, i, array_to_string(w[:i], ' ') AS x, array_to_string(w[i + 1:], ' ') AS y
      FROM (SELECT *, unnest(generate_series(1, k - 1)) AS i FROM c)),
s AS (SELECT x.lang, x.phrase, a, i, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.x JOIN f r ON r.lang = x.lang AND r.phrase = x.y JOIN n ON n.lang = x.lang),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS o FROM s) WHERE o = 1),
q AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i
      FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM c))),
d AS (SELECT lang, phrase, max(a) AS longer FROM q GROUP BY lang, phrase),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE d.longer IS NULL OR 100 * d.longer < 100 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000""")
def q_bounded_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.collocations import mine

    return mine(load(spark, sf_dir, "documents"), top=2000, least=100, longest=5)
