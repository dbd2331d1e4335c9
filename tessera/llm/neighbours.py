"""Approximate largest inner products: low-dimensional stable projections
indexed by a k-d tree, with a chi-square stopping test.

With one more coordinate, sqrt(M^2 - |x|^2) for rows and 0 for queries
(M the largest norm), larger inner products are smaller distances.  Rows
are projected on m Gaussian directions; a squared projected distance over
the squared distance follows chi-square with m degrees of freedom.

A query visits the leaves of a k-d tree over the projections in the order
of their distance and verifies their rows by the true inner product.  It
stops when the next leaf's squared projected distance is at least
chi2(m, confidence) times the squared distance of the k-th best so far: a
nearer row left out would have to project that far, which happens with
probability 1 - confidence.  So each true neighbour is found with at
least that confidence, whatever the data.

Rows are dealt by id into blocks of a bounded size, each with a tree of
its own; a block meets the queries in chunks.  Equal vectors of a block
are one point of the tree that carries its k + 1 smallest ids, which is
all that any query can return of them.

Defined results: null, empty and zero vectors and vectors with a null or
non-finite component take no part, nor do those whose length is not the
most frequent one (the smaller of two); rows that repeat an id count
once; ties go to the smaller id; a query with fewer candidates gets all;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, written
from tessera.session import ship_package

BLOCK, CHUNK, LEAF, SLACK = 1 << 14, 1 << 11, 256, 12
PACKED = "n int, ids binary, vectors binary, owner binary, leaves binary, boxes binary"


def usable(vector: Column) -> Column:
    """Finite, without nulls and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def chi_square(m: int, confidence: float) -> float:
    """Quantile of chi-square with an even number of degrees of freedom."""
    low, high = 0.0, 100.0 * m
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if below < confidence else (low, x)
    return high


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """One more coordinate brings every row to the norm sqrt(top)."""
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(1, keepdims=True), 0))], 1)


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim + 1, m))


def tree(p: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points by leaf and the leaves' borders: halves at the
    median of the widest dimension until ``leaf`` points are left."""
    order, borders, todo = np.arange(len(p)), [0], [(0, len(p))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            borders.append(hi)
            continue
        part, mid = order[lo:hi], (hi - lo) // 2
        widest = np.ptp(p[part], axis=0).argmax()
        order[lo:hi] = part[np.argpartition(p[part, widest], mid)]
        todo += [(lo + mid, hi), (lo, lo + mid)]
    return order, np.array(borders)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products summed in the order of the components, so
    that equal vectors get equal scores wherever they lie."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def pack_block(ids: np.ndarray, x: np.ndarray, k: int, top: float, way: np.ndarray, dtype) -> tuple:
    """The index of a block: unique vectors in leaf order, the ids of each
    (``owner``: its place), leaf borders and their projected boxes."""
    unique, owner = np.unique(x, axis=0, return_inverse=True)
    p = lifted(unique, top) @ way
    order, leaves = tree(p, LEAF)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    owner = place[owner.reshape(-1)]
    by = np.lexsort((ids, owner))
    ids, owner = ids[by], owner[by]
    nth = np.arange(len(ids)) - np.searchsorted(owner, owner)
    ids, owner = ids[nth <= k], owner[nth <= k]
    boxes = np.stack([np.minimum.reduceat(p[order], leaves[:-1]), np.maximum.reduceat(p[order], leaves[:-1])])
    return (len(unique), ids.tobytes(), unique[order].astype(dtype).tobytes(), owner.astype(np.int32).tobytes(),
            leaves.astype(np.int32).tobytes(), boxes.tobytes())


def search(queries: np.ndarray, query_ids: np.ndarray, index: pd.Series, k: int, top: float, way: np.ndarray, limit: float, dtype) -> pd.DataFrame:
    """The k best of a block for each query: (query_id, vec_id, score)."""
    x = np.frombuffer(index["vectors"], dtype).reshape(index["n"], -1).astype(float)
    ids, owner = np.frombuffer(index["ids"], np.int64), np.frombuffer(index["owner"], np.int32)
    leaves = np.frombuffer(index["leaves"], np.int32)
    boxes = np.frombuffer(index["boxes"]).reshape(2, len(leaves) - 1, -1)
    p = np.concatenate([queries, np.zeros((len(queries), 1))], 1) @ way
    far = np.zeros((len(queries), len(leaves) - 1))
    for d in range(p.shape[1]):
        gap = np.maximum(np.maximum(boxes[0, :, d] - p[:, d, None], p[:, d, None] - boxes[1, :, d]), 0)
        far += gap * gap
    turn = np.argsort(far, axis=1, kind="stable")
    norm = top + (queries * queries).sum(1)
    keep = k + SLACK
    best = np.full((len(queries), keep), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.arange(len(queries))
    for r in range(turn.shape[1]):
        # the (k + 1)-th best: one of the points may be the query itself
        kth = np.partition(best[live], keep - k - 1, axis=1)[:, keep - k - 1]
        live = live[~(far[live, turn[live, r]] >= limit * np.maximum(norm[live] - 2 * kth, 0)) | (kth == -np.inf)]
        if not len(live):
            break
        leaf = turn[live, r]
        by = np.argsort(leaf, kind="stable")
        at = np.append(np.flatnonzero(np.diff(leaf[by], prepend=-1)), len(by))
        for lo, hi in zip(at[:-1], at[1:]):
            q = live[by[lo:hi]]
            a, b = leaves[leaf[by[lo]]], leaves[leaf[by[lo]] + 1]
            s = queries[q] @ x[a:b].T
            i, j = np.nonzero(s >= best[q].min(1)[:, None])
            found.append((q[i], a + j, s[i, j]))
            both = np.concatenate([best[q], s], 1)
            best[q] = np.partition(both, both.shape[1] - keep, axis=1)[:, -keep:]
    q, row, s = (np.concatenate(c) for c in zip(*found))
    good = s >= best[q].min(1)
    q, row = q[good], row[good]
    score = exact(queries[q], x[row])
    first, size = np.searchsorted(owner, row), np.searchsorted(owner, row, "right") - np.searchsorted(owner, row)
    place = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    q, score, vec = np.repeat(q, size), np.repeat(score, size), ids[place]
    other = vec != query_ids[q]
    q, score, vec = q[other], score[other], vec[other]
    by = np.lexsort((vec, -score, q))
    q, score, vec = q[by], score[by], vec[by]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return pd.DataFrame({"query_id": query_ids[q[nth < k]], "vec_id": vec[nth < k], "score": score[nth < k]})


def nearest(rows: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            m: int = 8, confidence: float = 0.99, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id satisfies
    ``is_query`` its k nearest other rows by inner product."""
    spark = rows.sparkSession
    ship_package(spark)
    element = rows.schema[vector].dataType.elementType.simpleString()
    dtype = np.float32 if element == "float" else np.float64
    fine = pick(rows, vec_id=vec_id, v=vector).where("vec_id is not null").where(usable(F.col("v"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = fine.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), F.max(norm).alias("top"), F.count_if(is_query(F.col("vec_id"))).alias("q")).orderBy(F.desc("n"), "dim").first()
    if stats is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, top = stats["dim"], stats["top"]
    blocks, parts = -(-stats["n"] // BLOCK), max(1, -(-stats["q"] // CHUNK))
    way, limit = directions(dim, m, seed), chi_square(m, confidence)
    fine = fine.where(F.size("v") == dim)

    def arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        pdf = pdf.assign(key=pdf["v"].map(tuple)).sort_values(["vec_id", "key"]).drop_duplicates("vec_id")
        return pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_list()).astype(float)

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(int(key[0]), *pack_block(*arrays(pdf), k, top, way, dtype))], columns=["part", *(c.split(" ")[0] for c in PACKED.split(", "))])

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = arrays(pdf)
        return pd.DataFrame([(int(key[0]), len(ids), ids.tobytes(), x.astype(dtype).tobytes())], columns=["part", "n", "ids", "vectors"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        index, queries = pdf[pdf["leaves"].notna()], pdf[pdf["leaves"].isna()]
        if index.empty or queries.empty:
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        q = queries.iloc[0]
        x = np.frombuffer(q["vectors"], dtype).reshape(q["n"], -1).astype(float)
        return search(x, np.frombuffer(q["ids"], np.int64), index.iloc[0], k, top, way, limit, dtype)

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).groupBy("part")

    index = written(dealt(fine, blocks).applyInPandas(build, "part int, " + PACKED), "index")
    chunks = dealt(fine.where(is_query(F.col("vec_id"))), parts).applyInPandas(gather, "part int, n int, ids binary, vectors binary")
    names = [c.split(" ")[0] for c in PACKED.split(", ")]
    sides = index.select(F.col("part").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("chunk"), *names).unionByName(
        chunks.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("part").alias("chunk"), "n", "ids", "vectors"),
        allowMissingColumns=True)
    found = sides.groupBy("block", "chunk").applyInPandas(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
