"""Vector operators over blocked cells.

M6: scaled dot-product softmax lookup (attention re-aimed as retrieval):
each query's weights over its group's permitted keys (causal: key
position <= query position), output = weighted mean of the values.
Each cell emits online-softmax partials ``(max, sum exp, sum exp*v)``
per query; partials merge exactly with the log-sum-exp rule.

A15: greedy embedding matching (BERTScore's aggregation): every token's
best cosine on the other side of its pair; P, R, F1 per pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.blocked import cogroup_cells

_PARTIAL = ("grp long, qpos long, m double, l double, n_keys long, qo double, osum double, "
            "o array<double>")


def _empty_partials() -> pd.DataFrame:
    f, i = np.zeros(0, dtype=np.float64), np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"grp": i, "qpos": i, "m": f, "l": f, "n_keys": i, "qo": f, "osum": f,
                         "o": pd.Series([], dtype=object)})


def _stack(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col]) if len(col) else np.zeros((0, 0))


def _causal_cells(qkv: DataFrame, block: int, causal: bool) -> tuple[DataFrame, DataFrame]:
    """Query and key rows with the cells ``(_g, _qb, _kb)`` they take part
    in.  Blocks are ranges of ``block`` positions, so a causal cell whose
    keys all come later than its queries is never made."""
    at = F.floor(F.col("pos") / block)
    spans = qkv.groupBy("grp").agg(F.min(at).alias("_lo"), F.max(at).alias("_hi")).withColumnRenamed("grp", "_s")
    rows = qkv.withColumn("_b", at).join(spans, F.col("grp") == F.col("_s"))
    kb = F.sequence("_lo", F.col("_b") if causal else F.col("_hi"))
    qb = F.sequence(F.col("_b") if causal else F.col("_lo"), F.col("_hi"))
    q = rows.select("grp", F.col("pos").alias("qpos"), F.col("vec").alias("qvec"), F.col("_b").alias("_qb"), F.explode(kb).alias("_kb"))
    k = rows.select(F.col("grp").alias("_rgrp"), F.col("pos").alias("kpos"), F.col("vec").alias("kvec"),
                    F.explode(qb).alias("_qb"), F.col("_b").alias("_kb"))
    return q, k


def dot_softmax_lookup(qkv: DataFrame, causal: bool = True, block: int = 1024,
                       with_vector: bool = True) -> DataFrame:
    """M6 on ``(grp, pos, vec)`` (self-lookup: queries = keys = values; a
    group is a sequence, positions are not negative).

    Returns per query: ``n_keys``, ``max_weight``, ``out_dot_q`` (output
    . query), ``out_sum`` (sum of output entries) and, if ``with_vector``,
    the output vector ``out``.
    """
    from tessera.session import ship_package

    ship_package(qkv.sparkSession)
    names = ["grp", "qpos", "m", "l", "n_keys", "qo", "osum"] + ["o"] * with_vector
    schema = ", ".join(f for f in _PARTIAL.split(", ") if f.split(" ")[0] in names)

    def cell(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            return _empty_partials()[names]
        qm, km = _stack(lp["qvec"]), _stack(rp["kvec"])
        s = qm @ km.T / np.sqrt(qm.shape[1])
        allowed = np.ones_like(s, dtype=bool)
        if causal:
            allowed = rp["kpos"].to_numpy()[None, :] <= lp["qpos"].to_numpy()[:, None]
        s = np.where(allowed, s, -np.inf)
        m = s.max(axis=1)
        keep = np.isfinite(m)
        if not keep.any():
            return _empty_partials()[names]
        e = np.where(allowed[keep], np.exp(s[keep] - m[keep, None]), 0.0)
        o = e @ km
        out = pd.DataFrame({
            "grp": lp["grp"].to_numpy()[keep], "qpos": lp["qpos"].to_numpy()[keep],
            "m": m[keep], "l": e.sum(axis=1), "n_keys": allowed[keep].sum(axis=1).astype(np.int64),
            "qo": (o * qm[keep]).sum(axis=1), "osum": o.sum(axis=1)})
        return out.assign(o=list(o)) if with_vector else out

    q, k = _causal_cells(qkv, block, causal)
    parts = q.groupBy("grp", "_qb", "_kb").cogroup(k.groupBy("_rgrp", "_qb", "_kb")).applyInPandas(cell, schema)
    mx = F.max("m").over(Window.partitionBy("grp", "qpos"))
    wt = parts.withColumn("_w", F.exp(F.col("m") - mx))
    aggs = [F.sum(F.col("l") * F.col("_w")).alias("L"), F.sum("n_keys").alias("n_keys"),
            F.sum(F.col("qo") * F.col("_w")).alias("QO"), F.sum(F.col("osum") * F.col("_w")).alias("OS")]
    if with_vector:
        from pyspark.ml.functions import array_to_vector, vector_to_array
        from pyspark.ml.stat import Summarizer
        aggs.append(vector_to_array(Summarizer.sum(array_to_vector("o"), F.col("_w"))).alias("O"))
    g = wt.groupBy("grp", "qpos").agg(*aggs)
    cols = [F.col("grp"), F.col("qpos").alias("pos"), "n_keys", (1.0 / F.col("L")).alias("max_weight"),
            (F.col("QO") / F.col("L")).alias("out_dot_q"), (F.col("OS") / F.col("L")).alias("out_sum")]
    if with_vector:
        cols.append(F.transform("O", lambda x: x / F.col("L")).alias("out"))
    return g.select(*cols)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _best(own: str, other: str) -> Column:
    """Mean over ``own`` of the largest cosine with a vector of ``other``."""
    best = F.transform(own, lambda a: F.array_max(F.transform(F.col(other), lambda b: _dot(a, b))))
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.size(own)


def greedy_match_f1(tv: DataFrame, block: int = 1024, small: int = 64) -> DataFrame:
    """A15 on ``(pair_id, side, pos, vec)``: side 0 = candidate, 1 = reference.

    A pair with tokens on one side only scores 0, and a zero vector has
    cosine 0 with everything.  Pairs of at most ``small`` tokens a side are
    gathered into one row and compared by array expressions; larger ones
    meet in blocked cells.  Both give the same values.
    """
    norm = F.sqrt(_dot(F.col("vec"), F.col("vec")))
    unit = tv.select("pair_id", "side", "pos", F.when(norm > 0, F.transform("vec", lambda x: x / norm))
                     .otherwise(F.transform("vec", lambda x: x * 0.0)).alias("vec"))
    size = unit.groupBy("pair_id").agg(F.count_if(F.col("side") == 0).alias("_na"), F.count_if(F.col("side") == 1).alias("_nb")) \
        .withColumnRenamed("pair_id", "_p")
    sized = unit.join(size, F.col("pair_id") == F.col("_p")).drop("_p")
    both = (F.col("_na") > 0) & (F.col("_nb") > 0)
    fits = (F.col("_na") <= small) & (F.col("_nb") <= small)
    one_sided = size.filter(~both).select(F.col("_p").alias("pair_id"), F.lit(0.0).alias("precision"), F.lit(0.0).alias("recall"))
    side = lambda n: F.collect_list(F.when(F.col("side") == n, F.col("vec")))
    gathered = sized.filter(both & fits).groupBy("pair_id").agg(side(0).alias("_a"), side(1).alias("_b"))
    in_row = gathered.select("pair_id", _best("_a", "_b").alias("precision"), _best("_b", "_a").alias("recall"))
    rest = sized.filter(both & ~fits)
    a = rest.filter(F.col("side") == 0).select("pair_id", F.col("pos").alias("apos"), F.col("vec").alias("avec"))
    b = rest.filter(F.col("side") == 1).select("pair_id", F.col("pos").alias("bpos"), F.col("vec").alias("bvec"))

    def cell(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            i = np.zeros(0, dtype=np.int64)
            return pd.DataFrame({"pair_id": i, "side": i.astype(np.int32), "pos": i,
                                 "best": np.zeros(0, dtype=np.float64)})
        s = _stack(lp["avec"]) @ _stack(rp["bvec"]).T
        pid = lp["pair_id"].iloc[0]
        return pd.DataFrame({
            "pair_id": np.full(len(lp) + len(rp), pid, dtype=np.int64),
            "side": np.r_[np.zeros(len(lp), dtype=np.int32), np.ones(len(rp), dtype=np.int32)],
            "pos": np.r_[lp["apos"].to_numpy(), rp["bpos"].to_numpy()].astype(np.int64),
            "best": np.r_[s.max(axis=1), s.max(axis=0)]})

    parts = cogroup_cells(a, b, "pair_id", "apos", "bpos", cell,
                          "pair_id long, side int, pos long, best double", block)
    best = parts.groupBy("pair_id", "side", "pos").agg(F.max("best").alias("best"))
    in_cells = best.groupBy("pair_id").agg(F.avg(F.when(F.col("side") == 0, F.col("best"))).alias("precision"),
                                           F.avg(F.when(F.col("side") == 1, F.col("best"))).alias("recall"))
    pr = in_row.unionByName(in_cells).unionByName(one_sided)
    p, r = F.col("precision"), F.col("recall")
    return pr.select("pair_id", p, r, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"))
