"""Metric golden cases and brute-force checks."""

import math
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.text import characters
from tessera.operators import clfmetrics as cm
from tessera.operators import genmetrics as gm
from tessera.operators.vectors import dot_softmax_lookup, greedy_match_f1

SENT = "the quick brown fox jumps over the lazy dog near the river bank"


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, prediction string, reference string")


def test_identical_pairs(spark):
    p = _pairs(spark, [(1, SENT, SENT), (2, "a b c d e", "a b c d e")])
    assert abs(gm.bleu(p).first()["bleu"] - 100.0) < 1e-9
    assert abs(gm.chrf(p).first()["chrf"] - 100.0) < 1e-9
    r = {x["pair_id"]: x for x in gm.rouge_n(p).collect()}
    assert r[1]["rouge1"] == 1.0 and r[2]["rouge2"] == 1.0
    m = {x["pair_id"]: x["meteor"] for x in gm.meteor_exact(p).collect()}
    assert 0.99 < m[1] < 1.0  # one chunk still costs 0.5 * (1/m)^3
    assert gm.word_error_rate(p).first()["wer"] == 0.0


def test_no_overlap_and_empty(spark):
    p = _pairs(spark, [(1, "aaa bbb", "ccc ddd"), (2, "", "x y")])
    assert gm.bleu(p).first()["bleu"] == 0.0
    m = {x["pair_id"]: x["meteor"] for x in gm.meteor_exact(p).collect()}
    assert m == {1: 0.0, 2: 0.0}
    r = {x["pair_id"]: x["rouge1"] for x in gm.rouge_n(p).collect()}
    assert r == {1: 0.0, 2: 0.0}


def test_meteor_alignment_and_chunks(spark):
    # hyp "a b a c", ref "a c a b": last 'a' aligns with last 'a'.
    p = _pairs(spark, [(1, "a b a c", "a c a b")])
    r = gm.meteor_exact(p).first()
    assert r["matches"] == 4
    # aligned (hyp,ref): a0-a0, b1-b3, a2-a2, c3-c1 -> no adjacent runs -> 4 chunks
    assert r["chunks"] == 4
    prec = rec = 1.0
    fmean = prec * rec / (0.9 * prec + 0.1 * rec)
    assert abs(r["meteor"] - (1 - 0.5 * (4 / 4) ** 3) * fmean) < 1e-12


def lcs_brute(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


def lev_brute(a, b):
    d = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        prev, d[0] = d[0], i
        for j in range(1, len(b) + 1):
            cur = min(d[j] + 1, d[j - 1] + 1, prev + (a[i - 1] != b[j - 1]))
            prev, d[j] = d[j], cur
    return d[-1]


words = st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=12)


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_dynamic_programs(a, b):
    assert gm.lcs_len(a, b) == lcs_brute(a, b)
    assert gm.edit_distance(a, b) == lev_brute(a, b)


def test_rouge_lsum_union(spark):
    h = [["a", "b", "c"], ["d", "e"]]
    r = [["a", "c", "e"]]
    # union LCS of ref sentence vs both hyp sentences: {a, c} U {e} = 3 hits
    got = gm.rouge_lsum_pair(h, r)
    p, rr = 3 / 5, 3 / 3
    assert abs(got - 2 * p * rr / (p + rr)) < 1e-12


def test_clf_metrics_no_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "gold int, pred int")
    r = cm.clf_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_greedy_match_brute(spark):
    rng = np.random.default_rng(0)
    rows = []
    for pid in range(3):
        for pos in range(7):
            rows.append((pid, pos % 2, pid * 100 + pos, rng.normal(size=5).tolist()))
    tv = spark.createDataFrame(rows, "pair_id long, side int, pos long, vec array<double>")
    got = {r["pair_id"]: r for r in greedy_match_f1(tv, block=2).collect()}
    for pid in range(3):
        a = np.array([v for p, s, _, v in rows if p == pid and s == 0])
        b = np.array([v for p, s, _, v in rows if p == pid and s == 1])
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        s = a @ b.T
        prec, rec = s.max(axis=1).mean(), s.max(axis=0).mean()
        assert abs(got[pid]["precision"] - prec) < 1e-9 and abs(got[pid]["recall"] - rec) < 1e-9


def test_softmax_lookup_brute(spark):
    rng = np.random.default_rng(1)
    rows = [(g, i, rng.normal(size=4).tolist()) for g in range(2) for i in range(g * 50, g * 50 + 9)]
    qkv = spark.createDataFrame(rows, "grp long, pos long, vec array<double>")
    got = {(r["grp"], r["pos"]): r for r in dot_softmax_lookup(qkv, causal=True, block=2).collect()}
    for g, i, q in rows:
        keys = [(j, np.array(v)) for gg, j, v in rows if gg == g and j <= i]
        s = np.array([np.dot(q, v) / 2.0 for _, v in keys])
        w = np.exp(s - s.max())
        w /= w.sum()
        out = sum(wi * v for wi, (_, v) in zip(w, keys))
        r = got[(g, i)]
        assert r["n_keys"] == len(keys)
        assert abs(r["max_weight"] - w.max()) < 1e-9
        assert np.allclose(r["out"], out, atol=1e-9)
        assert abs(r["out_dot_q"] - float(np.dot(out, q))) < 1e-9


def test_cross_entropy_and_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 2), ([0.0, 0.0, 0.0], 0)], "logits array<double>, gold int")
    rows = cm.cross_entropy(cm.softmax_argmax(df), ignore_index=0).collect()
    assert len(rows) == 1 and rows[0]["argmax"] == 1
    lse = math.log(math.exp(1) + 2 * math.exp(3))
    assert abs(rows[0]["ce"] - (lse - 3.0)) < 1e-12
    ppl, _ = cm.lm_metrics(F.lit(25.0))
    assert spark.range(1).select(ppl).first()[0] == float("inf")


def test_bleu_hand_example(spark):
    p = _pairs(spark, [(1, "the cat sat on the mat", "the cat is on the mat")])
    r = gm.bleu(p).first()
    # clipped matches 5/6, 3/5, 1/4, 0/3 (first zero order: 100 / (2 * total))
    precisions = [100 * 5 / 6, 100 * 3 / 5, 100 * 1 / 4, 100 / (2 * 3)]
    expected = math.exp(sum(math.log(x) for x in precisions) / 4)
    assert abs(r["bleu"] - expected) < 1e-9 and r["bp"] == 1.0
    assert [round(r[f"p{n}"], 9) for n in range(1, 5)] == [round(x, 9) for x in precisions]


def test_character_ngrams_are_counted_without_a_row_each(spark):
    rows = [(1, "abcabc😀é", "abcab😀😀"), (1, "xyz", "yzx"), (2, None, "abc"), (3, "", ""), (None, "qq", "q"), (4, "aaaaaaaa", "aaaa"), (5, "a" * 300, None)]
    p = spark.createDataFrame(rows, "pair_id long, prediction string, reference string")
    got = gm.char_ngram_stats(p, F.col("prediction"), F.col("reference"), 6)
    assert "g#" not in got._jdf.queryExecution().executedPlan().toString()
    want = gm.ngram_stats(p, characters(F.col("prediction")), characters(F.col("reference")), range(1, 7), chars=True)
    key = lambda df: sorted(map(repr, df.select("pair_id", "n", "matches", "hyp_total", "ref_total").collect()))
    assert key(got) == key(want)
    assert gm.char_ngram_stats(p.limit(0), F.col("prediction"), F.col("reference"), 6).count() == 0


def test_edit_distance_of_long_sides_takes_no_table():
    a, b = ["x", "y"] * 10_000, ["y", "x"] * 10_000
    begun = time.process_time()
    assert gm.edit_distance(a, b) == 2 and gm.edit_distance(a, []) == 20_000 and gm.edit_distance([], b) == 20_000
    assert time.process_time() - begun < 2
