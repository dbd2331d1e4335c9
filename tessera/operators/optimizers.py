"""Fits of the two-class linear model on sparse features:
quasi-Newton, and mini-batch gradient steps.

Features are ``(id, term, x)``, labels ``(id, label)``; a document without
features counts by its label.  Weights are a table ``(term, w)`` for the
margin logit1 - logit0, the bias is a number; the vocabulary is never on
the driver, which gets sums and the numbers of the bias only.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import Blocks
from tessera.operators.linear import sigmoid
from tessera.operators.sampling import batch_assign
from tessera.plans.ranking import global_rank
from tessera.session import ensure_checkpoint_dir, ship_package


@dataclass
class Fit:
    """weights: (term, w).  gradient: its norm at the end."""
    weights: DataFrame
    bias: float
    iterations: int
    gradient: float
    loss: float


def softplus(m):
    """log(1 + exp(m)) without overflow."""
    return F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


def combination(state: list[str], weights: dict[str, float]):
    terms = [F.lit(float(weights[c])) * F.col(c) for c in state if weights.get(c)]
    return sum(terms[1:], terms[0]) if terms else F.lit(0.0)


def two_loops(gram: dict[tuple[str, str], float], pairs: int) -> dict[str, float]:
    """The direction -H g as a combination of the columns s0, y0, s1, y1,
    ... (oldest first) and g, from their inner products alone."""
    def dot(weights: dict[str, float], c: str) -> float:
        return sum(v * gram[min(k, c), max(k, c)] for k, v in weights.items())

    out = {"g": -1.0}
    alpha = {}
    for i in reversed(range(pairs)):
        alpha[i] = dot(out, f"s{i}") / gram[f"s{i}", f"y{i}"]
        out[f"y{i}"] = out.get(f"y{i}", 0.0) - alpha[i]
    if pairs:
        last = pairs - 1
        scale = gram[f"s{last}", f"y{last}"] / gram[f"y{last}", f"y{last}"]
        out = {k: v * scale for k, v in out.items()}
    for i in range(pairs):
        beta = dot(out, f"y{i}") / gram[f"s{i}", f"y{i}"]
        out[f"s{i}"] = out.get(f"s{i}", 0.0) + alpha[i] - beta
    return out


def quasi_newton_fit(x: DataFrame, y: DataFrame, reg: float = 0.05, tol: float = 1e-9, max_iter: int = 60,
                     memory: int = 5, id_col: str = "doc_id") -> Fit:
    """M1: the minimum of mean cross-entropy + reg / 2 * (|w|^2 + bias^2).

    L-BFGS with the last ``memory`` steps and gradient changes as columns
    beside the weights, so that the two loops need nothing but the inner
    products of these columns, one aggregate of a few numbers.  Margins are
    kept per document; a step along the direction moves them by its own
    margins, so one pass over the documents tries every step length.  An
    iteration reads the features twice (direction to margins, residuals to
    gradient) where they lie, in ``Blocks``.  Each iteration's tables are
    checkpointed.

    It stops when the gradient's norm is at most ``tol``.  Without labelled
    documents the weights are empty and the bias is 0."""
    if reg <= 0:
        raise ValueError("reg must be positive: without it separable labels have no minimum")
    ensure_checkpoint_dir(x.sparkSession)
    docs = y.select(F.col(id_col).alias("id"), F.col("label").cast("double").alias("y"), F.lit(0.0).alias("m")).checkpoint()
    xs = x.select(F.col(id_col).alias("id"), "term", F.col("x").cast("double").alias("x"))
    xs = xs.join(docs.select("id"), "id", "left_semi")
    n = docs.count()
    if not n:
        return Fit(xs.select("term", F.lit(0.0).alias("w")), 0.0, 0, 0.0, 0.0)
    blocks = Blocks(xs, n)

    def gradient(docs: DataFrame) -> DataFrame:
        return blocks.gradient(docs.groupBy(F.col("id").alias("rid")).agg(F.sum((sigmoid(F.col("m")) - F.col("y")) / n).alias("r")))

    state = gradient(docs).select("term", F.lit(0.0).alias("w"), F.col("gl").alias("g")).checkpoint()
    bias = {"w": 0.0, "g": docs.agg(F.sum((F.lit(0.5) - F.col("y")) / n)).first()[0]}
    pairs, loss, norm = 0, float(np.log(2)), 0.0
    lengths = [2.0 ** k for k in range(4, -13, -1)]
    for iteration in range(max_iter + 1):
        columns = [c for i in range(pairs) for c in (f"s{i}", f"y{i}")] + ["g", "w"]
        wanted = [(min(a, b), max(a, b)) for a, b in combinations_with_replacement(columns, 2)]
        sums = state.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)).alias(f"{a}_{b}") for a, b in wanted]).first()
        gram = {(a, b): sums[f"{a}_{b}"] + bias[a] * bias[b] for a, b in wanted}
        norm = gram["g", "g"] ** 0.5
        if norm <= tol or iteration == max_iter:
            break
        way = two_loops(gram, pairs)
        inner = lambda a, b: sum(v * w * gram[min(k, c), max(k, c)] for k, v in a.items() for c, w in b.items())
        wd, dd, ww = inner(way, {"w": 1.0}), inner(way, way), gram["w", "w"]
        step_bias = sum(v * bias[k] for k, v in way.items())
        moved = blocks.margins(state.select("term", combination(columns, way).alias("d")))
        docs = docs.join(moved, F.col("id") == F.col("mid"), "left").select(
            "id", "y", "m", (F.coalesce("dm", F.lit(0.0)) + F.lit(step_bias)).alias("dm")).checkpoint()
        at = {t: F.col("m") + F.lit(t) * F.col("dm") for t in lengths}
        tried = docs.agg(*[F.avg(softplus(m) - F.col("y") * m).alias(f"l{i}") for i, m in enumerate(at.values())],
                         *[F.avg(sigmoid(m) - F.col("y")).alias(f"b{i}") for i, m in enumerate(at.values())]).first()
        losses = [tried[f"l{i}"] + reg / 2 * (ww + 2 * t * wd + t * t * dd) for i, t in enumerate(lengths)]
        # near the minimum losses differ by less than they are rounded to: the full step then
        whole = lengths.index(1.0)
        best = min(range(len(lengths)), key=losses.__getitem__)
        best = whole if losses[whole] <= losses[best] + 1e-13 else best
        t, loss = lengths[best], losses[best]
        docs = docs.select("id", "y", (F.col("m") + F.lit(t) * F.col("dm")).alias("m"))
        keep = range(max(0, pairs - memory + 1), pairs)
        new_w = F.col("w") + F.lit(t) * combination(columns, way)
        grown = state.join(gradient(docs).withColumnRenamed("term", "gterm"), F.col("term") == F.col("gterm"), "left")
        grown = grown.withColumns({"nw": new_w, "ng": F.coalesce("gl", F.lit(0.0)) + F.lit(reg) * new_w})
        olds = [F.col(f"{c}{i}").alias(f"{c}{k}") for k, i in enumerate(keep) for c in "sy"]
        k = len(keep)
        state = grown.select("term", F.col("nw").alias("w"), F.col("ng").alias("g"), *olds,
                             (F.col("nw") - F.col("w")).alias(f"s{k}"), (F.col("ng") - F.col("g")).alias(f"y{k}")).checkpoint()
        nb, ng = bias["w"] + t * step_bias, tried[f"b{best}"] + reg * (bias["w"] + t * step_bias)
        bias = {f"{c}{j}": bias[f"{c}{i}"] for j, i in enumerate(keep) for c in "sy"} | {
            f"s{k}": nb - bias["w"], f"y{k}": ng - bias["g"], "w": nb, "g": ng}
        pairs = k + 1
    blocks.unpersist()
    return Fit(state.select("term", "w"), bias["w"], iteration, norm, loss)


def sgd_steps(w: np.ndarray, bias: float, batches: Iterable[tuple[list, np.ndarray]], lr: float) -> float:
    """The steps of mini-batches in order, on ``w`` itself; the new bias.

    A batch: its rows' features (places in w, values), and their labels."""
    change = np.zeros(len(w))
    for rows, label in batches:
        step, total = lr * 2 / len(rows), 0.0
        for (at, x), y in zip(rows, label):
            r = 1 / (1 + np.exp(-(np.dot(w[at], x) + bias))) - y
            change[at] += r * x
            total += r
        # only the batch's own terms move; a term named twice gets the same value twice
        touched = np.concatenate([at for at, _ in rows])
        w[touched] = w[touched] - step * change[touched]
        change[touched] = 0
        bias -= step * total
    return bias


def _cuts(batch: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal numbers."""
    at = [*np.flatnonzero(np.diff(batch, prepend=-1)).tolist(), len(batch)]
    return list(zip(at[:-1], at[1:]))


def sgd_block(docs: pa.Table, known: pa.Table, n: int, lr: float) -> pa.Table:
    """One block's mini-batches in order: (k, change) of its terms, k NULL
    for the bias, weighted by the block's share of ``n`` documents.

    ``docs``: (position, batch, y, ks, vs, bias); ``known``: the weights (k,
    w) of its terms.  Features stay in two flat arrays, 12 bytes each."""
    terms, start = known["k"].to_numpy(), known["w"].to_numpy()
    order = np.argsort(terms)
    terms, start = terms[order], start[order]
    ks = docs["ks"].combine_chunks()
    end = np.cumsum(pc.list_value_length(ks).to_numpy(zero_copy_only=False))
    place = np.searchsorted(terms, ks.flatten().to_numpy()).astype(np.int32)
    value = docs["vs"].combine_chunks().flatten().to_numpy()
    by_place = np.argsort(docs["position"].to_numpy(), kind="stable")
    batch, label = docs["batch"].to_numpy()[by_place], docs["y"].to_numpy()[by_place]
    rows = [(place[hi - size:hi], value[hi - size:hi]) for hi, size in zip(end[by_place], np.diff(end, prepend=0)[by_place])]
    w, before = start.copy(), docs["bias"][0].as_py()
    bias = sgd_steps(w, before, ((rows[lo:hi], label[lo:hi]) for lo, hi in _cuts(batch)), lr)
    share = len(batch) / n
    return pa.table({"k": pa.array([*terms, None], pa.int32()), "change": np.append(share * (w - start), share * (bias - before))})


class _File:
    """Numbers that are appended to a file of the task's own, which is gone
    when it ends, and then read where they lie: they take no memory but
    what the system has to spare."""

    def __init__(self, kind: type):
        self.kind, self.file = kind, tempfile.TemporaryFile()

    def append(self, values: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(values, self.kind).data)

    def array(self) -> np.ndarray:
        self.file.flush()
        if not self.file.tell():
            return np.zeros(0, self.kind)
        return np.frombuffer(mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ), self.kind)


def sgd_run(batches: Iterator[pa.RecordBatch], terms: int, n: int, lr: float, epochs: int, batch_size: int) -> Iterator[pa.RecordBatch]:
    """Every epoch's mini-batches in order: (k, w) of all terms, k NULL for
    the bias.

    ``batches``: (places, y, ks, vs) of every row; places: (epoch, position)
    each.  In memory are the weights (16 bytes a term, 24 if an epoch has
    other than ``n`` rows), a row's places (8 bytes an epoch) and its label;
    the features lie in files, 12 bytes each."""
    ks, vs, sizes, labels, n_rows = _File(np.int32), _File(np.float64), [], [], 0
    places: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(epochs)]
    for b in batches:
        ks.append(b.column("ks").flatten().to_numpy())
        vs.append(b.column("vs").flatten().to_numpy())
        sizes.append(pc.list_value_length(b.column("ks")).to_numpy(zero_copy_only=False))
        labels.append(b.column("y").to_numpy(zero_copy_only=False))
        p = b.column("places").flatten()
        row = np.repeat(np.arange(n_rows, n_rows + b.num_rows), pc.list_value_length(b.column("places")).to_numpy(zero_copy_only=False))
        epoch, position = (pc.struct_field(p, c).to_numpy(zero_copy_only=False) for c in ("epoch", "position"))
        for e in range(epochs):
            places[e].append((position[epoch == e].astype(np.uint32), row[epoch == e].astype(np.uint32)))
        n_rows += b.num_rows
    end = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
    label = np.concatenate([np.zeros(0), *labels])
    at, value = ks.array(), vs.array()
    w, bias = np.zeros(terms), 0.0
    for own in places:
        position, row = (np.concatenate([np.zeros(0, np.uint32), *x]) for x in zip(*own)) if own else (np.zeros(0, np.uint32),) * 2
        order = np.argsort(position, kind="stable")
        row, batch = row[order], (position[order] // batch_size).astype(np.int64)
        share, before = len(row) / n, bias
        start = None if share == 1 else w.copy()
        features = lambda some: [(at[end[i]:end[i + 1]], value[end[i]:end[i + 1]]) for i in some]
        bias = sgd_steps(w, bias, ((features(row[lo:hi].tolist()), label[row[lo:hi]]) for lo, hi in _cuts(batch)), lr)
        if start is not None:  # rows that repeat an id, or have none: as in a block
            w, bias = start + share * (w - start), before + share * (bias - before)
    for lo in range(0, terms, 1 << 20):
        yield pa.RecordBatch.from_pydict({"k": np.arange(lo, min(lo + (1 << 20), terms), dtype=np.int32), "w": w[lo:lo + (1 << 20)]})
    yield pa.RecordBatch.from_pydict({"k": pa.array([None], pa.int32()), "w": [bias]})


def sgd_fit(x: DataFrame, y: DataFrame, batch_size: int = 32, lr: float = 1.0, epochs: int = 10, seed: int = 42,
            block_batches: int | None = None, id_col: str = "doc_id") -> Fit:
    """M1: mini-batch gradient steps, w -= lr * 2 * mean((sigmoid(m) - y) x)
    over each batch, from zero weights.

    Batches are D7's: in every epoch the documents in the order of their
    seeded hash (the seed grows by 1 an epoch), the last one partial.  Each
    step needs the weights that the one before it left, so all of them are
    taken one after the other in one task, whatever the input's size: the
    features are made, numbered and ordered by the cluster and streamed to
    it, where they wait in files (``sgd_run``).

    Only a caller who asks for ``block_batches`` gets another schedule: the
    steps of a run of so many batches are taken in one task, each such block
    starts an epoch from the same weights, and what they have changed is
    averaged by their documents.

    Terms are numbered once, in their order, so that a task holds features
    as arrays of numbers; a document's places in all epochs are joined to
    its features once."""
    spark = x.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    labels = y.select(F.col(id_col).alias("id"), F.col("label").cast("double").alias("y")).checkpoint()
    xs = x.select(F.col(id_col).alias("xid"), "term", F.col("x").cast("double").alias("x"))
    n = labels.count()
    numbers = global_rank(labels.join(xs, F.col("id") == F.col("xid")).select("term").distinct(), ["term"], rank_col="k")
    numbers = numbers.select(F.col("term").alias("kterm"), F.col("k").cast("int").alias("k")).checkpoint()
    numbered = xs.join(numbers, F.col("term") == F.col("kterm")).select("xid", "k", "x")
    rows = labels.join(numbered, F.col("id") == F.col("xid"), "left").groupBy("id", "y").agg(
        F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "x")))).alias("f"))
    ids = labels.distinct().select("id", F.lit("train").alias("split"))
    places = None
    for epoch in range(epochs if n else 0):
        one = batch_assign(ids, "id", batch_size, seed + epoch).select(
            F.col("id").alias("bid"), F.struct(F.lit(epoch).alias("epoch"), "position", "batch").alias("p"))
        places = one if places is None else places.unionByName(one)
    weights, bias = numbers.select("k", F.lit(0.0).alias("w")), 0.0
    if places is not None:
        rows = rows.join(places.groupBy("bid").agg(F.collect_list("p").alias("places")), F.col("id") == F.col("bid")).select(
            "places", "y", F.col("f.k").alias("ks"), F.col("f.x").alias("vs")).checkpoint()
        if block_batches is None:
            weights, bias = _in_order(rows, numbers.count(), n, lr, epochs, batch_size)
        else:
            weights, bias = _in_blocks(rows, weights, n, lr, epochs, block_batches)
    named = numbers.withColumnsRenamed({"kterm": "term", "k": "nk"}).join(weights, F.col("nk") == F.col("k")).select("term", "w")
    return Fit(named, bias, epochs if n else 0, float("nan"), float("nan"))


def _in_order(rows: DataFrame, terms: int, n: int, lr: float, epochs: int, batch_size: int) -> tuple[DataFrame, float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sgd_run(batches, terms, n, lr, epochs, batch_size)

    # rows are checkpointed: the one task reads them, it does not make them
    fitted = rows.coalesce(1).mapInArrow(run, "k int, w double").checkpoint()
    return fitted.where("k is not null"), fitted.where("k is null").first()["w"]


def _in_blocks(rows: DataFrame, weights: DataFrame, n: int, lr: float, epochs: int, block_batches: int) -> tuple[DataFrame, float]:
    bias = 0.0

    def held(docs: pa.Table) -> pa.Table:
        ks = np.unique(docs["ks"].combine_chunks().flatten().to_numpy())
        return pa.table({"block": pa.array(np.full(len(ks), docs["block"][0].as_py()), pa.int64()), "hk": pa.array(ks, pa.int32())})

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        return sgd_block(docs, known, n, lr)

    for epoch in range(epochs):
        own = F.explode(F.filter("places", _of_epoch(epoch))).alias("p")
        docs = rows.select(own, "y", "ks", "vs").select(
            F.floor(F.col("p.batch") / block_batches).alias("block"), "p.position", "p.batch", "y", "ks", "vs", F.lit(bias).alias("bias"))
        terms = docs.groupBy("block").applyInArrow(held, "block long, hk int")
        known = terms.join(weights, F.col("hk") == F.col("k")).select("block", "k", "w")
        changes = docs.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, "k int, change double")
        summed = changes.groupBy("k").agg(F.sum("change").alias("change")).checkpoint()
        bias += summed.where("k is null").first()["change"]
        weights = weights.join(summed.withColumnRenamed("k", "ck"), F.col("k") == F.col("ck"), "left").select(
            "k", (F.col("w") + F.coalesce("change", F.lit(0.0))).alias("w")).checkpoint()
    return weights, bias


def _of_epoch(epoch: int):
    return lambda p: p["epoch"] == epoch
