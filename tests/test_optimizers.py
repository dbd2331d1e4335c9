"""Fits of the linear model against plain numpy runs."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import blocks, linear, optimizers


def data(spark, n=90, kinds=25, seed=5):
    """Sparse rows (some without features) with noisy labels."""
    rng = random.Random(seed)
    x, y = [], []
    for i in range(n):
        for t in rng.sample(range(kinds), rng.randint(0, 6)):
            x.append((i, f"t{t}", rng.random()))
        y.append((i, int(rng.random() < (0.8 if sum(v for k, _, v in x if k == i) > 1.2 else 0.3))))
    dense = np.zeros((n, kinds + 1))
    dense[:, kinds] = 1
    for i, t, v in x:
        dense[i, int(t[1:])] = v
    return (spark.createDataFrame(x, "doc_id long, term string, x double"),
            spark.createDataFrame(y, "doc_id long, label int"), dense, np.array([v for _, v in y], float))


def vector(fit, kinds=25):
    w = np.zeros(kinds + 1)
    for r in fit.weights.collect():
        w[int(r["term"][1:])] = r["w"]
    w[kinds] = fit.bias
    return w


def sigma(m):
    return 1 / (1 + np.exp(-m))


@pytest.mark.parametrize("reg", [0.05, 0.001])
def test_quasi_newton_stops_at_the_minimum(spark, reg):
    x, y, dense, label = data(spark)
    fit = optimizers.quasi_newton_fit(x, y, reg=reg, tol=1e-8)
    w = vector(fit)
    g = dense.T @ (sigma(dense @ w) - label) / len(label) + reg * w
    assert fit.gradient <= 1e-8 and np.linalg.norm(g) < 2e-8 and fit.iterations < 60
    v = np.zeros(len(w))
    for _ in range(100):  # Newton's method
        p = sigma(dense @ v)
        h = dense.T @ (dense * (p * (1 - p))[:, None]) / len(label) + reg * np.eye(len(v))
        v -= np.linalg.solve(h, dense.T @ (p - label) / len(label) + reg * v)
    assert np.abs(w - v).max() < 1e-6


def test_the_bound_on_iterations_holds(spark):
    x, y, _, _ = data(spark, 30)
    fit = optimizers.quasi_newton_fit(x, y, tol=0.0, max_iter=2)
    assert fit.iterations == 2 and fit.gradient > 0


def slow_sgd(dense, label, batch, lr, epochs, seed, blocks):
    w = np.zeros(dense.shape[1])
    n = len(label)
    for e in range(epochs):
        order = sorted(range(n), key=lambda i: (hashlib.md5(f"{seed + e}:{i}".encode()).hexdigest(), i))
        cuts = [order[k:k + batch] for k in range(0, n, batch)]
        change = np.zeros(len(w))
        for b in range(0, len(cuts), blocks):
            own = w.copy()
            for rows in cuts[b:b + blocks]:
                own -= lr * 2 / len(rows) * dense[rows].T @ (sigma(dense[rows] @ own) - label[rows])
            change += sum(map(len, cuts[b:b + blocks])) / n * (own - w)
        w = w + change
    return w


@pytest.mark.parametrize("blocks", [1024, 3])
def test_mini_batches_equal_a_sequential_run(spark, blocks):
    """One block is the plain run; more start each epoch alike and are averaged."""
    x, y, dense, label = data(spark)
    fit = optimizers.sgd_fit(x.repartition(4), y.repartition(3), batch_size=8, epochs=3, seed=7, block_batches=blocks)
    want = slow_sgd(dense, label, 8, 1.0, 3, 7, blocks)
    assert np.abs(vector(fit) - want).max() < 1e-12


def test_mini_batches_follow_each_other_whatever_their_number(spark):
    """More batches than the 1024 after which their steps used to be averaged."""
    x, y, dense, label = data(spark, 1100)
    fit = optimizers.sgd_fit(x.repartition(4), y.repartition(3), batch_size=1, epochs=2, seed=7)
    want = slow_sgd(dense, label, 1, 1.0, 2, 7, 1100)
    assert np.abs(want - slow_sgd(dense, label, 1, 1.0, 2, 7, 1024)).max() > 1e-3
    assert np.abs(vector(fit) - want).max() < 1e-9


def test_a_run_keeps_its_features_out_of_memory():
    docs, each, kinds = 4000, 400, 2000
    rng = np.random.default_rng(5)
    ks = np.concatenate([np.sort(rng.choice(kinds, each, False)) for _ in range(docs)]).astype(np.int32)
    vs, label = rng.random(docs * each) / each, rng.integers(0, 2, docs).astype(float)

    def batches():
        for lo in range(0, docs, 500):
            first = pa.array(np.arange(0, 500 * each + 1, each), pa.int32())
            some = slice(lo * each, (lo + 500) * each)
            yield pa.RecordBatch.from_pydict({
                "places": [[{"epoch": 0, "position": i}] for i in range(lo, lo + 500)], "y": label[lo:lo + 500],
                "ks": pa.ListArray.from_arrays(first, pa.array(ks[some])), "vs": pa.ListArray.from_arrays(first, pa.array(vs[some]))})

    tracemalloc.start()
    parts = list(optimizers.sgd_run(batches(), kinds, docs, 1.0, 1, 32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * docs * each
    dense = np.zeros((docs, kinds + 1))
    dense[np.repeat(np.arange(docs), each), ks] = vs
    dense[:, kinds] = 1
    w = np.zeros(kinds + 1)
    for lo in range(0, docs, 32):
        some = dense[lo:lo + 32]
        w -= 2 / len(some) * some.T @ (sigma(some @ w) - label[lo:lo + 32])
    assert np.abs(pa.Table.from_batches(parts)["w"].to_numpy() - w).max() < 1e-12


def test_a_block_of_mini_batches_is_held_as_arrays():
    """A task needs some bytes a feature, not an object each (2000 documents of 200 features)."""
    docs, each, kinds = 2000, 200, 5000
    rng = np.random.default_rng(3)
    ks = np.concatenate([np.sort(rng.choice(kinds, each, False)) for _ in range(docs)]).astype(np.int32)
    offsets = pa.array(np.arange(0, docs * each + 1, each), pa.int32())
    vs, label = rng.random(docs * each) / each, rng.integers(0, 2, docs).astype(float)
    table = pa.table({"position": np.arange(docs), "batch": np.arange(docs) // 32, "y": label, "bias": np.zeros(docs),
                      "ks": pa.ListArray.from_arrays(offsets, pa.array(ks)), "vs": pa.ListArray.from_arrays(offsets, pa.array(vs))})
    known = pa.table({"k": pa.array(np.arange(kinds), pa.int32()), "w": np.zeros(kinds)})
    tracemalloc.start()
    got = optimizers.sgd_block(table, known, docs, 1.0)["change"].to_numpy()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * docs * each
    dense = np.zeros((docs, kinds + 1))
    dense[np.repeat(np.arange(docs), each), ks] = vs
    dense[:, kinds] = 1
    w = np.zeros(kinds + 1)
    for lo in range(0, docs, 32):
        some = dense[lo:lo + 32]
        w -= 2 / len(some) * some.T @ (sigma(some @ w) - label[lo:lo + 32])
    assert np.abs(got - w).max() < 1e-12


def test_passes_over_blocks_leave_the_features_where_they_are(spark):
    x, _, dense, _ = data(spark, 1500, 60)
    x = x.withColumnRenamed("doc_id", "id")
    x = x.unionByName(x.where("term = 't3'"))  # repeated features count each
    dense[:, 3] *= 2
    b = blocks.Blocks(x, 1500)
    rng = np.random.default_rng(1)
    d, r = rng.random(60), rng.random(1500)
    weights = spark.createDataFrame([(f"t{i}", float(v)) for i, v in enumerate(d)] + [("t0x", 1.0)], "term string, d double")
    dots = b.margins(weights)
    plan = dots._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("InMemoryTableScan")]
    got = {v["mid"]: v["dm"] for v in dots.collect()}
    want = dense[:, :60] @ d
    assert all(abs(got.get(i, 0.0) - want[i]) < 1e-9 for i in range(1500))
    some = spark.createDataFrame([(i, float(v) if i % 2 else None) for i, v in enumerate(r)], "rid long, r double")
    got = {v["term"]: v["gl"] for v in b.gradient(some).collect()}
    want = dense[1::2, :60].T @ r[1::2]
    assert all(abs(got[f"t{i}"] - want[i]) < 1e-9 for i in range(60))
    none = b.gradient(some.where("r is null")).collect()
    assert len(none) == 60 and all(v["gl"] is None for v in none)
    assert b.rows.count() > 1
    b.unpersist()


@pytest.mark.parametrize("cut", [3, 7, 10_000])
def test_blocks_are_bounded_by_their_features(cut):
    """However many documents there are and however they are cut into batches; a document stays whole."""
    rng = random.Random(cut)
    rows = [(i, f"t{rng.randrange(40)}", rng.random()) for i in range(200) for _ in range(rng.choice([0, 1, 2, 9, 30]))]
    ids, terms, x = map(list, zip(*rows))
    table = pa.table({"id": ids, "term": terms, "x": x})
    got = list(blocks.deal(iter(table.to_batches(max_chunksize=cut)), 25, 3))
    sizes = [len(b["x"][0].as_py()) for b in got]
    assert all(25 <= n < 25 + 30 for n in sizes[:-1]) and len(set(b["block"][0].as_py() for b in got)) == len(got) > 20
    back = [(b["ids"][0].as_py()[i], b["terms"][0].as_py()[j], v) for b in got for i, j, v in zip(*(b[c][0].as_py() for c in ("row", "col", "x")))]
    assert back == rows
    own = [set(b["ids"][0].as_py()) for b in got]
    assert sum(map(len, own)) == len(set(ids))
    assert not list(blocks.deal(iter([]), 25, 0))


def test_gradient_descent_with_repeated_ids_and_missing_labels(spark):
    x, y, dense, label = data(spark, 40)
    y = y.where("doc_id <> 7").unionByName(y.where("doc_id = 5")).unionByName(
        spark.createDataFrame([(7, None), (None, 1)], "doc_id long, label int"))
    n, rows, has = 42, np.ones(40), np.ones(40)
    rows[5], has[7] = 2, 0
    w = np.zeros(dense.shape[1])
    for _ in range(3):
        r = has * rows * (sigma(rows * (dense[:, :-1] @ w[:-1] + rows * w[-1])) - label)
        w -= 2 / n * np.append(dense[:, :-1].T @ r, (rows * r).sum())
    got, c = linear.gd_fit(x, y, steps=3)
    assert abs(c - w[-1]) < 1e-12
    for v in got.collect():
        assert abs(v["w"] - w[int(v["term"][1:])]) < 1e-12


def test_empty_training_sets(spark):
    x = spark.createDataFrame([], "doc_id long, term string, x double")
    y = spark.createDataFrame([], "doc_id long, label int")
    for fit in (optimizers.quasi_newton_fit(x, y), optimizers.sgd_fit(x, y)):
        assert fit.weights.count() == 0 and fit.bias == 0.0
    w, c = linear.gd_fit(x, y)
    assert w.count() == 0 and c == 0.0
    some = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, label int")
    fit = optimizers.quasi_newton_fit(x, some, tol=1e-8)  # the bias alone
    assert abs(sigma(fit.bias) - 2 / 3 + 0.05 * fit.bias) < 1e-7
    assert optimizers.sgd_fit(x, some, epochs=1).bias == pytest.approx(1 / 3)
