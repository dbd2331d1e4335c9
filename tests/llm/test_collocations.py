import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tessera.llm import collocations
from tests.llm import awkward


def slow(rows, top, least, longest=5):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = sizes[lang], []
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = {q for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if (q := p[i:j]) != p and q in often and a >= often[q]}
        for p, a in often.items():
            if p not in inside:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def run(df, **options):
    return sorted(tuple(r) for r in collocations.mine(df, **options).collect())


def test_awkward_rows_by_brute_force(spark):
    docs = awkward.frame(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert run(docs, top=50, least=3, bits=1 << 20) == slow(rows, 50, 3)
    assert run(awkward.empty(spark), bits=1 << 16) == []


def corpus(seed, n_docs=160, kinds=60):
    rng = random.Random(seed)
    vocabulary = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(kinds)]
    weights = [1 / (1 + i) for i in range(kinds)]
    fixed = [rng.choices(vocabulary, k=rng.randint(2, 7)) for _ in range(25)]
    rows = []
    for _ in range(n_docs):
        words = []
        for _ in range(rng.randint(0, 30)):
            words += rng.choice(fixed) if rng.random() < 0.6 else rng.choices(vocabulary, weights, k=2)
            words.append(rng.choice(["", "", ".", "\n", "\t", "x,y", "a  b"]))
        rows.append((rng.choice([None, "und", "en", "fr"]), " ".join(words)))
    return rows


@pytest.mark.parametrize("options", [
    {"top": 2000, "least": 4, "bits": 1 << 18},
    {"top": 5, "least": 3, "bits": 1 << 18, "first": 4},  # many rounds, a high threshold
    {"top": 12, "least": 5, "bits": 1 << 16, "first": 1},
])
def test_phrases_by_brute_force(spark, options):
    rows = corpus(options["top"])
    got = run(spark.createDataFrame(rows, "lang string, text string").repartition(4), **options)
    assert got == slow(rows, options["top"], options["least"])


def test_bounds_leave_words_uncounted(spark, monkeypatch):
    """A frequent word that no phrase of the result can begin or end with
    never enters the frontier."""
    rows = [("en", f"rare{i % 9} pair{i % 9} . the of . of the . the a . a of . the the") for i in range(300)]
    fronts = []
    real = collocations.frontier

    def spy(*args):
        out = real(*args)
        fronts.append({r["phrase"] for r in out.collect()})
        return out

    monkeypatch.setattr(collocations, "frontier", spy)
    got = run(spark.createDataFrame(rows, "lang string, text string"), top=9, least=10, bits=1 << 16, first=4)
    assert got == slow(rows, 9, 10)
    assert not any("the" in f or "of" in f for f in fronts)


def test_products_beyond_64_bits(spark):
    candidates = spark.createDataFrame([("x", "a b", 10 ** 13, 2)], "lang string, phrase string, f long, words int")
    counts = spark.createDataFrame([("x", "a", 10 ** 13 + 1), ("x", "b", 10 ** 13)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("x", 10 ** 15)], "lang string, n long")
    row = collocations.scored(counts, candidates, sizes).first()
    assert row["score"] == 1000 * 10 ** 13 * 10 ** 15 // ((10 ** 13 + 1) * 10 ** 13)


def test_phrases_are_joined_by_one_space():
    p = collocations.Pieces(pa.array(["A \t b.c  D", None, "e f"]), pa.array(["en", None, "fr"]))
    at = [i for i in range(len(p.words)) if p.run[i] >= 2]
    import numpy as np
    assert p.phrases(np.array(at), 2).to_pylist() == ["a b", "c d", "e f"]
