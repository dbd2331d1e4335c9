"""Stems, shifted edits and resampling against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from tessera.functions import stems
from tessera.operators import bootstrap, genmetrics as gm, shifts

# examples of the algorithm's publication, through all its steps
GOLDEN = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc
hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow
inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll by by yes ye 2nd 2nd enjoyed enjoi""".split()


def test_golden_stems(spark):
    import duckdb
    words, want = GOLDEN[::2], GOLDEN[1::2]
    assert [stems.stem(w) for w in words] == want
    rows = duckdb.sql(f"SELECT {stems.sql_stem('w')} FROM (SELECT unnest({words}) AS w, unnest(range({len(words)})) AS i) ORDER BY i").fetchall()
    assert [r[0] for r in rows] == want
    df = spark.createDataFrame([(1, words), (2, []), (3, None)], "id int, t array<string>")
    got = {r["id"]: r["s"] for r in df.select("id", stems.stem_tokens(df["t"], 4).alias("s")).collect()}
    assert got[1] == [s if len(w) > 4 else w for w, s in zip(words, want)] and got[2] == [] and got[3] == []


def test_stemmed_scores(spark):
    p = spark.createDataFrame([(1, "the cats were running", "a cat was running runs"), (2, "", "x"), (3, "relational", "relate")],
                              "pair_id long, prediction string, reference string")
    m = {r["pair_id"]: (r["matches"], r["chunks"]) for r in gm.meteor_stemmed(p).collect()}
    assert m == {1: (2, 2), 2: (0, 0), 3: (1, 1)}
    exact = {r["pair_id"]: r["matches"] for r in gm.meteor_exact(p).collect()}
    assert exact == {1: 1, 2: 0, 3: 0}
    r = {x["pair_id"]: x["rouge1"] for x in gm.rouge_n(p, stem=True).collect()}
    assert r[3] == 1.0 and abs(r[1] - 2 * 2 / (4 + 5)) < 0.12 and r[2] == 0.0


def slow_shift(h, r):
    """Every block, every place, every aligned reference span."""
    now, best = gm.edit_distance(h, r), None
    for length in range(1, min(shifts.LONGEST, len(h) - 1, len(r)) + 1):
        for s in range(len(h) - length + 1):
            block, rest = h[s:s + length], h[:s] + h[s + length:]
            for j in range(len(r) - length + 1):
                if r[j:j + length] != block:
                    continue
                for p in range(len(rest) + 1):
                    if p != s and abs(p - s) <= shifts.FARTHEST:
                        left = gm.edit_distance(rest[:p], r[:j]) + gm.edit_distance(rest[p:], r[j + length:])
                        best = min(best or (now, 0, 0, 0), (left, -length, s, p))
    return best if best and best[0] < now else None


def slow_ter(h, r):
    n = 0
    while found := slow_shift(h, r):
        _, length, s, p = found
        block, rest = h[s:s - length], h[:s] + h[s - length:]
        h, n = rest[:p] + block + rest[p:], n + 1
    return n, gm.edit_distance(h, r)


def test_shifts_by_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        r = [rng.choice("abcdef") for _ in range(rng.randint(0, 8))]
        h = r[:]
        for _ in range(rng.randint(0, 3)):
            a, b = sorted((rng.randint(0, len(h)), rng.randint(0, len(h))))
            h = h[:a] + h[b:] + h[a:b]
        h = [rng.choice("abcx") if rng.random() < 0.1 else t for t in h]
        got = shifts.shifted_edits(h, r)
        assert got == slow_ter(h, r), (h, r)
        assert sum(got) <= gm.edit_distance(h, r)


def test_longer_shifts_by_brute_force():
    rng = random.Random(9)
    for _ in range(12):
        r = [rng.choice("abcdefghij") for _ in range(rng.randint(10, 30))]
        h = r[:rng.randint(4, 14)]
        for _ in range(3):
            a, b = sorted((rng.randint(0, len(h)), rng.randint(0, len(h))))
            h = h[:a] + h[b:] + h[a:b]
        assert shifts.shifted_edits(h, r) == slow_ter(h, r), (h, r)


def test_only_blocks_that_may_win_are_tried(monkeypatch):
    rows, plain = [], shifts.go_on
    monkeypatch.setattr(shifts, "go_on", lambda row, words, refs: rows.append(words.size) or plain(row, words, refs))
    r = [f"w{i}" for i in range(60)]
    h = r[:20] + r[23:50] + r[20:23] + r[50:]
    assert shifts.shifted_edits(h, r) == (1, 0)
    assert sum(rows) <= 2 * 60 + 2 * shifts.AT_ONCE * shifts.FARTHEST  # of 60 blocks of a word, 59 of two, ...


def test_a_block_counts_once(spark):
    p = spark.createDataFrame([(1, "d e f a b c", "a b c d e f"), (2, "", "a"), (3, "a", "")], "pair_id long, prediction string, reference string")
    row = shifts.translation_edit_rate(p).first()
    assert (row["shifts"], row["edits"], row["ref_words"]) == (1, 2, 7)
    far = ["x"] * 60 + ["k", "l"]
    assert shifts.shifted_edits(far, ["k", "l"] + ["x"] * 60)[0] == 0 or shifts.FARTHEST >= 60


def test_resampling_by_plain_draws(spark):
    rows = [(i, float(i % 7), float(i * i % 11)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(4)
    got = {r["replicate"]: (r["a"], r["b"]) for r in bootstrap.replicate_means(df, "id", ["a", "b"], 20, seed=9).collect()}
    assert len(got) == 20
    for rep in range(20):
        copies = []
        for i, _, _ in rows:
            u = int(hashlib.md5(f"9:{i}:{rep // 8}".encode()).hexdigest()[4 * (rep % 8):4 * (rep % 8) + 4], 16)
            copies.append(sum(u >= round(65536 * sum(math.exp(-1) / math.factorial(x) for x in range(k + 1))) for k in range(8)))
        a, b = (sum(c * r[j] for c, r in zip(copies, rows)) / sum(copies) for j in (1, 2))
        assert got[rep] == pytest.approx((a, b))
    q = {r["measure"]: (r["low"], r["mid"], r["high"]) for r in bootstrap.interval(df, "id", ["a"], 200).collect()}["a"]
    mean, spread = np.mean([r[1] for r in rows]), np.std([r[1] for r in rows]) / 50 ** 0.5
    assert q[0] < mean < q[2] and 2.5 * spread < q[2] - q[0] < 5.5 * spread
