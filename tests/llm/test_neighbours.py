import math

import numpy as np
import pytest

from tessera.llm import neighbours as N


def brute(rows, k, queries):
    fine = {}
    for i, v in sorted(((i, v) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)), key=repr):
        fine.setdefault(i, v)
    lengths = [len(v) for v in fine.values()]
    dim = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    fine = {i: v for i, v in fine.items() if len(v) == dim}
    out = {}
    for q in fine:
        if queries(q):
            scores = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def run(spark, rows, k, kind="double", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, score double, v int, part int")
    out = {}
    for r in N.nearest(df, lambda c: c % 5 == 0, k, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_chi_square():
    assert N.chi_square(8, 0.95) == pytest.approx(15.507, abs=1e-3)
    assert N.chi_square(2, 0.5) == pytest.approx(2 * math.log(2))


def test_awkward_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.integers(-2, 3, 6).astype(float).tolist() for _ in range(300)] + [[1.0, 0.0, 0.0, 0.0, 0.0, 0.0]] * 150
    rows = [(i, v, 0.0, 1, 2) for i, v in enumerate(vectors)]
    bad = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [1.0, 2.0]]
    rows += [(1000 + 5 * i, v, 0.0, 1, 2) for i, v in enumerate(bad)] + [(None, [1.0] * 6, 0.0, 1, 2), rows[10], rows[10]]
    want = brute([r[:2] for r in rows], 20, lambda q: q % 5 == 0)
    assert run(spark, rows, 20) == want


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 2.0], 0.0, 1, 2), (1, [3.0, 1.0], 0.0, 1, 2), (5, [1.0, 1.0], 0.0, 1, 2)]
    assert run(spark, rows, 20) == brute([r[:2] for r in rows], 20, lambda q: q % 5 == 0)
    assert run(spark, rows[:1], 20) == {} and run(spark, [], 20) == {}


def test_recall_over_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24)) * 4
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 24))).astype(np.float32)
    x *= rng.uniform(0.2, 2, (4000, 1)).astype(np.float32)
    monkeypatch.setattr(N, "BLOCK", 900)
    monkeypatch.setattr(N, "CHUNK", 200)
    got = run(spark, [(i, v.tolist(), 0.0, 1, 2) for i, v in enumerate(x)], 10, "float", confidence=0.95)
    s = x[::5].astype(float) @ x.T.astype(float)
    s[np.arange(800), np.arange(0, 4000, 5)] = -np.inf
    true = np.argsort(-s, axis=1)[:, :10]
    recall = np.mean([len({i for i, _ in got[5 * q]} & set(t.tolist())) / 10 for q, t in enumerate(true)])
    assert recall >= 0.9


def test_the_stop_skips_leaves():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 30
    x = np.repeat(centres, 500, axis=0) + rng.normal(size=(10_000, 16))
    way, top = N.directions(16, 8, 1), float((x * x).sum(1).max())
    index = dict(zip(["n", "ids", "vectors", "owner", "leaves", "boxes"], N.pack_block(np.arange(10_000), x, 5, top, way, np.float64)))
    tight = N.search(x[:50], np.arange(50), index, 5, top, way, N.chi_square(8, 0.9), np.float64)
    whole = N.search(x[:50], np.arange(50), index, 5, top, way, float("inf"), np.float64)
    same = len(tight.merge(whole, on=["query_id", "vec_id"])) / len(whole)
    assert same >= 0.9
