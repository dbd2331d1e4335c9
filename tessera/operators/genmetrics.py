"""Text-generation metrics as distributed corpus aggregations.

Input: ``(pair_id, prediction, reference)``.  Pairs are clustered by
``pair_id`` once; every per-pair step (n-gram explode, clipped counts,
alignment windows) then groups by keys that start with ``pair_id`` and
runs without another exchange.  Only the final corpus sums shuffle, and
those are a few rows per partition.

Formulas follow the public metric definitions: corpus BLEU (13a tokens,
exponential smoothing, brevity penalty), chrF (character 1-6-grams,
whitespace removed, beta 2, precision/recall averaged over orders),
ROUGE-N/L/Lsum (per-pair F, plain mean), METEOR exact-match stage, and
word error rate (TER without block shifts).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.stems import stem_tokens
from tessera.functions.text import WS, bleu_tokens, char_ngrams, meteor_tokens, ngram_strings
from tessera.functions.text import rouge_tokens, ter_tokens
from tessera.plans.ranking import cluster
from tessera.session import ship_package

# Metric parameters of the public definitions.
BLEU_MAX_N = 4
CHRF_ORDER = 6
CHRF_BETA = 2.0
METEOR_ALPHA, METEOR_BETA, METEOR_GAMMA = 0.9, 3.0, 0.5
LOG_ZERO = -9999999999.0


def ngram_stats(pairs: DataFrame, hyp: Column, ref: Column, orders, chars: bool = False,
                key: str = "pair_id") -> DataFrame:
    """Per ``(pair, n)``: clipped matches, hypothesis and reference n-gram totals.

    ``hyp``/``ref`` are arrays of tokens (of characters when ``chars``).
    Pairs with no n-gram of an order get no row for it.
    """
    # Cluster the (small) pair rows by key once; the exploded n-grams then
    # aggregate by (key, n, gram) inside their partition, with no exchange.
    # Sides and orders are exploded first, so no array holds more than the
    # n-grams of one side and order.
    base = cluster(pairs, key).select(key, hyp.alias("_h"), ref.alias("_r"))
    sides = F.array(F.struct(F.lit(0).alias("s"), F.col("_h").alias("t")), F.struct(F.lit(1).alias("s"), F.col("_r").alias("t")))
    one = base.select(key, F.explode(sides).alias("x")).select(
        key, "x.s", "x.t", F.explode(F.array(*[F.lit(n) for n in orders])).alias("n"))
    grams = char_ngrams(F.col("t"), F.col("n")) if chars else ngram_strings(F.col("t"), F.col("n"))
    ex = one.select(key, "s", "n", F.explode_outer(grams).alias("g")).filter(F.col("g").isNotNull())
    per_gram = ex.groupBy(key, "n", "g").agg(F.count_if(F.col("s") == 0).alias("h"), F.count_if(F.col("s") == 1).alias("r"))
    return per_gram.groupBy(key, "n").agg(
        F.sum(F.least("h", "r")).cast("long").alias("matches"),
        F.sum("h").cast("long").alias("hyp_total"), F.sum("r").cast("long").alias("ref_total"))


#: Characters whose n-grams a task counts together (or one pair's).
CHARS = 1 << 19


def char_ngram_stats(pairs: DataFrame, hyp: Column, ref: Column, most: int, key: str = "pair_id") -> DataFrame:
    """``ngram_stats`` for the character n-grams of texts, orders 1 to ``most``.

    Texts are counted as arrays of code points, many pairs at a time, and
    one row a pair and order comes out; n-grams are never rows."""
    ship_package(pairs.sparkSession)
    texts = cluster(pairs.select(key, hyp.alias("_h"), ref.alias("_r")), key).groupBy(key).agg(
        F.collect_list("_h").alias("_h"), F.collect_list("_r").alias("_r"))  # rows of one key count together

    @F.arrow_udf("array<struct<n:int,matches:long,hyp_total:long,ref_total:long>>")
    def count(h: pa.Array, r: pa.Array) -> pa.Array:
        sizes = [np.add.reduceat(np.append(pc.utf8_length(c.flatten()).to_numpy(zero_copy_only=False), 0), first) * (size > 0)
                 for c in (h, r) for size in [pc.list_value_length(c).to_numpy(zero_copy_only=False)]
                 for first in [np.cumsum(size) - size]] if len(h) else [np.zeros(0, int)] * 2
        before = np.cumsum(sizes[0] + sizes[1])
        cuts = np.unique(np.concatenate([[0], 1 + np.flatnonzero(np.diff(before // CHARS)), [len(h)]])).tolist()
        parts = [char_counts(h[lo:hi], r[lo:hi], most) for lo, hi in zip(cuts[:-1], cuts[1:])]
        m, t, u = (np.concatenate([p[i] for p in parts] or [np.zeros((0, most), np.int64)]) for i in range(3))
        there = t + u > 0
        n = np.broadcast_to(np.arange(1, most + 1, dtype=np.int32), there.shape)
        rows = pa.StructArray.from_arrays([pa.array(x[there]) for x in (n, m, t, u)], ["n", "matches", "hyp_total", "ref_total"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(there.sum(1))), pa.int32()), rows)

    return texts.select(key, F.explode(count("_h", "_r")).alias("s")).select(key, "s.*")


def char_counts(h: pa.Array, r: pa.Array, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """[pair, n - 1]: clipped matches, hypothesis and reference totals, for
    lists of texts a pair.  An n-gram is numbered by the number of its first
    n - 1 characters and its last character."""
    pairs = len(h)
    flat = [c.flatten() for c in (h, r)]
    points = np.frombuffer("".join(t for c in flat for t in c.to_pylist()).encode("utf-32-le"), np.uint32)
    length = np.concatenate([pc.utf8_length(c).to_numpy(zero_copy_only=False) for c in flat]).astype(np.int64)
    of = np.concatenate([np.repeat(np.arange(pairs), pc.list_value_length(c).to_numpy(zero_copy_only=False)) for c in (h, r)])
    pair, side = np.repeat(of, length), np.repeat(np.arange(2), [length[:len(flat[0])].sum(), length[len(flat[0]):].sum()])
    room = np.repeat(np.cumsum(length), length) - np.arange(len(points))  # characters left in the text
    kinds, char = np.unique(points, return_inverse=True)
    char = char.astype(np.int64)
    at, number = np.arange(len(points)), pair.astype(np.int64)
    out = [np.zeros((pairs, most), np.int64) for _ in range(3)]
    for n in range(1, most + 1):
        stay = room[at] >= n
        at, number = at[stay], number[stay] * len(kinds) + char[at[stay] + n - 1]
        if not len(at):
            break
        grams, number = np.unique(number, return_inverse=True)
        mine = side[at] == 0
        fh, fr = np.bincount(number[mine], minlength=len(grams)), np.bincount(number[~mine], minlength=len(grams))
        owner = np.empty(len(grams), np.int64)
        owner[number] = pair[at]
        for column, f in zip(out, (np.minimum(fh, fr), fh, fr)):
            np.add.at(column[:, n - 1], owner, f)
    return out[0], out[1], out[2]


def bleu(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
         key: str = "pair_id") -> DataFrame:
    """Corpus BLEU (0-100) with per-order precisions and brevity penalty."""
    st = ngram_stats(pairs, bleu_tokens(pred), bleu_tokens(ref), range(1, BLEU_MAX_N + 1), key=key)
    tot = st.groupBy("n").agg(F.sum("matches").alias("m"), F.sum("hyp_total").alias("t"),
                              F.sum("ref_total").alias("r"))
    # One row per order (at most 4) pivoted to columns: a bounded result.
    # Unigram totals are the corpus lengths (sys_len, ref_len).
    wide = tot.groupBy().pivot("n", list(range(1, BLEU_MAX_N + 1))).agg(
        F.first("m").alias("m"), F.first("t").alias("t"), F.first("r").alias("r"))
    cols = []
    zeros_before = F.lit(0)
    for n in range(1, BLEU_MAX_N + 1):
        m = F.coalesce(F.col(f"{n}_m"), F.lit(0)).cast("double")
        t = F.coalesce(F.col(f"{n}_t"), F.lit(0)).cast("double")
        zeros_here = zeros_before + F.when(m == 0, 1).otherwise(0)
        p = (F.when(t == 0, F.lit(0.0))
             .when(m == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros_here) * t))
             .otherwise(F.lit(100.0) * m / t))
        cols.append(p.alias(f"p{n}"))
        zeros_before = zeros_here
    any_m = sum([F.coalesce(F.col(f"{n}_m"), F.lit(0)) for n in range(2, BLEU_MAX_N + 1)],
                F.coalesce(F.col("1_m"), F.lit(0)))
    out = wide.select(*cols, any_m.alias("any_m"),
                      F.coalesce(F.col("1_t"), F.lit(0)).cast("long").alias("sys_len"),
                      F.coalesce(F.col("1_r"), F.lit(0)).cast("long").alias("ref_len"))
    sys_len, ref_len = F.col("sys_len"), F.col("ref_len")
    bp = F.when(sys_len < ref_len,
                F.when(sys_len > 0, F.exp(1 - ref_len / sys_len)).otherwise(F.lit(0.0))).otherwise(1.0)
    logs = [F.when(F.col(f"p{n}") > 0, F.log(F.col(f"p{n}"))).otherwise(F.lit(LOG_ZERO))
            for n in range(1, BLEU_MAX_N + 1)]
    score = F.when(F.col("any_m") == 0, F.lit(0.0)).otherwise(
        bp * F.exp(sum(logs[1:], logs[0]) / BLEU_MAX_N))
    return out.select(score.alias("bleu"), bp.alias("bp"), "sys_len", "ref_len",
                      *[F.col(f"p{n}") for n in range(1, BLEU_MAX_N + 1)])


def chrf(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
         key: str = "pair_id") -> DataFrame:
    """A10: corpus chrF (0-100): precision and recall averaged over the
    orders with both sides non-empty, then F-beta."""
    nows = lambda c: F.regexp_replace(F.col(c), WS, "")
    st = char_ngram_stats(pairs, nows(pred), nows(ref), CHRF_ORDER, key)
    tot = st.groupBy("n").agg(F.sum("matches").alias("m"), F.sum("hyp_total").alias("h"),
                              F.sum("ref_total").alias("r"))
    ok = (F.col("h") > 0) & (F.col("r") > 0)
    agg = tot.agg(F.sum(F.when(ok, F.col("m") / F.col("h"))).alias("sp"),
                  F.sum(F.when(ok, F.col("m") / F.col("r"))).alias("sr"),
                  F.sum(F.when(ok, 1).otherwise(0)).alias("k"))
    p = F.coalesce(F.col("sp") / F.col("k"), F.lit(0.0))
    r = F.coalesce(F.col("sr") / F.col("k"), F.lit(0.0))
    b2 = CHRF_BETA ** 2
    score = F.when(p + r > 0, 100.0 * (1 + b2) * p * r / (b2 * p + r)).otherwise(F.lit(0.0))
    return agg.select(score.alias("chrf"), p.alias("char_precision"), r.alias("char_recall"))


def rouge_n(pairs: DataFrame, orders=(1, 2), pred: str = "prediction", ref: str = "reference",
            key: str = "pair_id", stem: bool = False) -> DataFrame:
    """Per-pair ROUGE-N F1; pairs without n-grams score 0.  ``stem``:
    on the stems of tokens of over three characters."""
    tokens = (lambda c: stem_tokens(rouge_tokens(c), longer_than=3)) if stem else rouge_tokens
    if stem:
        ship_package(pairs.sparkSession)
    st = ngram_stats(pairs, tokens(pred), tokens(ref), orders, key=key)
    p = F.col("matches") / F.greatest(F.col("hyp_total"), F.lit(1))
    r = F.col("matches") / F.greatest(F.col("ref_total"), F.lit(1))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    wide = st.select(key, "n", f.alias("f")).groupBy(key).pivot("n", list(orders)).agg(F.first("f"))
    out = pairs.select(key).join(wide, key, "left")
    return out.select(key, *[F.coalesce(F.col(str(n)), F.lit(0.0)).alias(f"rouge{n}") for n in orders])


def meteor_exact(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
                 key: str = "pair_id") -> DataFrame:
    """METEOR with the exact-match stage only (no stems, no synonyms).

    The k-th last occurrence of a word in the hypothesis aligns with its
    k-th last occurrence in the reference; chunks are maximal runs of
    adjacent matches in both sides.
    """
    base = cluster(pairs, key).select(key, meteor_tokens(pred).alias("_h"), meteor_tokens(ref).alias("_r"))
    m = _aligned(_occurrences(base, key, "_h", "hp"), _occurrences(base, key, "_r", "rp"), key)
    return _meteor_score(base, m, key)


def meteor_stemmed(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
                   key: str = "pair_id") -> DataFrame:
    """METEOR with the exact stage and the stem stage: words that found
    no equal word align by their stems in the same way."""
    ship_package(pairs.sparkSession)
    base = cluster(pairs, key).select(key, meteor_tokens(pred).alias("_h"), meteor_tokens(ref).alias("_r"))
    base = base.select("*", stem_tokens(F.col("_h")).alias("_hs"), stem_tokens(F.col("_r")).alias("_rs"))
    exact = _aligned(_occurrences(base, key, "_h", "hp"), _occurrences(base, key, "_r", "rp"), key)

    def rest(stems: str, pos: str) -> DataFrame:
        taken = exact.select(F.col(key).alias("_k"), F.col(pos).alias("_p"))
        e = base.select(key, F.posexplode(stems).alias(pos, "tok"))
        return _numbered(e.join(taken, (F.col(key) == F.col("_k")) & (F.col(pos) == F.col("_p")), "left_anti"), key, pos)

    stems = _aligned(rest("_hs", "hp"), rest("_rs", "rp"), key)
    return _meteor_score(base, exact.unionByName(stems), key)


def _numbered(e: DataFrame, key: str, pos: str) -> DataFrame:
    return e.withColumn("k", F.row_number().over(Window.partitionBy(key, "tok").orderBy(F.desc(pos))))


def _occurrences(base: DataFrame, key: str, c: str, pos: str) -> DataFrame:
    return _numbered(base.select(key, F.posexplode(c).alias(pos, "tok")), key, pos)


def _aligned(h: DataFrame, r: DataFrame, key: str) -> DataFrame:
    return h.join(r, [key, "tok", "k"]).select(key, "hp", "rp")


def _meteor_score(base: DataFrame, m: DataFrame, key: str) -> DataFrame:
    lens = base.select(key, F.size("_h").alias("lh"), F.size("_r").alias("lr"))
    w = Window.partitionBy(key).orderBy("hp")
    brk = F.when((F.lag("hp").over(w) == F.col("hp") - 1) & (F.lag("rp").over(w) == F.col("rp") - 1), 0) \
        .otherwise(1)
    per = m.select(key, brk.alias("b")).groupBy(key).agg(F.count("*").alias("matches"),
                                                           F.sum("b").alias("chunks"))
    j = lens.join(per, key, "left").fillna(0, ["matches", "chunks"])
    mm = F.col("matches").cast("double")
    prec, rec = mm / F.col("lh"), mm / F.col("lr")
    fmean = prec * rec / (METEOR_ALPHA * prec + (1 - METEOR_ALPHA) * rec)
    pen = METEOR_GAMMA * F.pow(F.col("chunks") / mm, METEOR_BETA)
    score = F.when((F.col("matches") == 0) | (F.col("lh") == 0) | (F.col("lr") == 0), F.lit(0.0)) \
        .otherwise((1 - pen) * fmean)
    return j.select(key, "matches", "chunks", score.alias("meteor"))

# --------------------------------------------------------------- dynamic programs
# Per-pair Python helpers run inside Arrow batches (pandas_udf); each row's
# cost is the product of its two lengths, on whole texts.


def lcs_columns(ref, can):
    """One integer for each token of ``can``: bit i is 0 where the longest
    common subsequence with the tokens of ``can`` so far grows from the
    first i to the first i + 1 tokens of ``ref``.

    A column follows from the last by one addition of machine words (the
    carries run through each stretch up to the next match), so the table
    of lengths is never built."""
    places: dict = {}
    for i, t in enumerate(ref):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << len(ref)) - 1
    flat = full
    for t in can:
        at = flat & places.get(t, 0)
        flat = ((flat + at) | (flat - at)) & full
        yield flat


def lcs_len(a, b) -> int:
    flat = (1 << len(a)) - 1
    for flat in lcs_columns(a, b):
        pass
    return len(a) - flat.bit_count()


def edit_distance(a, b) -> int:
    """Word Levenshtein distance.  A row of the table is held as the bits
    where it goes up (``up``) and down (``down``), and the next one follows
    by one addition of machine words, as in ``lcs_columns``."""
    a, b = (x.tolist() if isinstance(x, np.ndarray) else x for x in (a, b))
    places: dict = {}
    for i, t in enumerate(b):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << len(b)) - 1
    top = full ^ (full >> 1)
    up, down, edits = full, 0, len(b)
    if not full:
        return len(a)
    for t in a:
        equal = places.get(t, 0)
        flat = (((equal & up) + up) ^ up) | equal
        more, less = down | (full & ~(flat | up)), up & flat
        if more & top:
            edits += 1
        elif less & top:
            edits -= 1
        more, less = (more << 1 | 1) & full, (less << 1) & full
        equal |= down
        up, down = less | (full & ~(equal | more)), more & equal
    return edits


def _fmeasure(p: float, r: float) -> float:
    return 2 * p * r / (p + r) if p + r > 0 else 0.0


def rouge_l_pair(hyp, ref) -> float:
    if len(hyp) == 0 or len(ref) == 0:
        return 0.0
    n = lcs_len(ref, hyp)
    return _fmeasure(n / len(hyp), n / len(ref))


def lcs_positions(ref, can) -> int:
    """Bits of the ``ref`` positions in one longest common subsequence: of
    several the one that ends earliest in ``ref``.

    From the last column on, the open prefix of ``ref`` is cut to its last
    position that grows the length or equals the column's token; an equal
    token is taken."""
    columns = list(lcs_columns(ref, can))
    places: dict = {}
    for i, t in enumerate(ref):
        places[t] = places.get(t, 0) | 1 << i
    taken, open_ = 0, (1 << len(ref)) - 1
    for t, flat in zip(reversed(can), reversed(columns)):
        equal = places.get(t, 0) & open_
        top = (equal | (~flat & open_)).bit_length()
        if not top:
            break
        last = 1 << (top - 1)
        if equal & last:
            taken |= last
            open_ = last - 1
        else:
            open_ = 2 * last - 1
    return taken


def rouge_lsum_pair(hyp_sents, ref_sents) -> float:
    """Summary-level LCS over newline-separated sentences: reference
    positions that any hypothesis sentence aligns with count once, and no
    token counts more often than either side holds it."""
    hyp_sents = [list(s) for s in hyp_sents if len(s)]
    ref_sents = [list(s) for s in ref_sents if len(s)]
    m, n = sum(map(len, ref_sents)), sum(map(len, hyp_sents))
    if not m or not n:
        return 0.0
    aligned: Counter = Counter()
    for ref in ref_sents:
        union = 0
        for hyp in hyp_sents:
            union |= lcs_positions(ref, hyp)
        aligned.update(t for i, t in enumerate(ref) if union >> i & 1)
    held = Counter(t for s in hyp_sents for t in s)
    hits = (aligned & held).total()
    return _fmeasure(hits / n, hits / m)


def rouge_l(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
            key: str = "pair_id") -> DataFrame:
    """Per-pair ROUGE-L and ROUGE-Lsum F1 (Arrow-batched dynamic program)."""
    ship_package(pairs.sparkSession)
    @F.pandas_udf("double")
    def _rl(h: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([rouge_l_pair(list(a), list(b)) for a, b in zip(h, r)], dtype="float64")

    @F.pandas_udf("double")
    def _rls(h: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([rouge_lsum_pair([list(s) for s in a], [list(s) for s in b])
                          for a, b in zip(h, r)], dtype="float64")

    sent_toks = lambda c: F.transform(F.split(F.col(c), "\n"), lambda s: rouge_tokens(s))
    base = cluster(pairs, key).select(key, rouge_tokens(pred).alias("_h"), rouge_tokens(ref).alias("_r"),
                                     sent_toks(pred).alias("_hs"), sent_toks(ref).alias("_rs"))
    return base.select(key, _rl("_h", "_r").alias("rougeL"), _rls("_hs", "_rs").alias("rougeLsum"))


def word_error_rate(pairs: DataFrame, pred: str = "prediction", ref: str = "reference",
                    key: str = "pair_id") -> DataFrame:
    """Corpus WER x 100 = sum of word edits / sum of reference words."""
    ship_package(pairs.sparkSession)
    @F.pandas_udf("long")
    def _ed(h: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([edit_distance(list(a), list(b)) for a, b in zip(h, r)], dtype="int64")

    base = cluster(pairs, key).select(key, ter_tokens(pred).alias("_h"), ter_tokens(ref).alias("_r"))
    per = base.select(key, _ed("_h", "_r").alias("edits"), F.size("_r").alias("ref_words"))
    return per.agg(F.sum("edits").alias("edits"), F.sum("ref_words").cast("long").alias("ref_words")).select(
        "edits", "ref_words",
        (F.lit(100.0) * F.col("edits") / F.greatest(F.col("ref_words"), F.lit(1))).alias("wer"))
