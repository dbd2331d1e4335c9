from pyspark.sql import functions as F

from tessera.llm.mixing import mix_sources, targets
from tests.llm import awkward


def shared(sizes, weights, share, most):
    """Targets by dealing the excess anew until none is above its limit."""
    left, total, out = dict(sizes), share * sum(sizes.values()), {}
    while left:
        unit = total / sum(weights[s] for s in left)
        full = [s for s in left if unit * weights[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weights[s] for s in left}
        for s in full:
            out[s] = most * sizes[s]
            total -= out[s]
            del left[s]
    return out


def test_targets_by_redealing(spark):
    for sizes in ({"a": 10, "b": 2000, "c": 300, "d": 1}, {"a": 5, "b": 5, "c": 5}, {"a": 0, "b": 7, "c": 0, "d": 4000}):
        names = sorted(sizes)
        weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in targets(df, (3, 1, 2), 1.5, 2.0).collect()}
        want = shared(sizes, weights, 1.5, 2.0)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in names), (got, want)


def test_systematic_copies_meet_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 97 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b").when(F.col("id") % 11 > 0, "c").alias("source"))
    out = mix_sources(docs, ["doc_id", "source"]).cache()
    rows = out.collect()
    assert len(rows) == 6000 and all(0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] for r in rows)
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"), F.sum("size").alias("s"),
                                       F.first("source_size").alias("ss"), F.sum("copies").alias("c"), F.count("*").alias("n")).collect():
        assert abs(r["t"] - r["w"]) <= 2 * 97 and r["s"] == r["ss"]
        # boundaries crossed: the expected copies, give or take one
        assert abs(r["c"] - r["n"] * r["w"] / r["ss"]) <= 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_sources(docs.repartition(7), ["doc_id", "source"]).collect()))


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    out = mix_sources(docs, ["doc_id", "text", "source", "size"]).drop("size")
    rows = out.collect()
    assert len(rows) == docs.count() and all(r["taken"] == 0 for r in rows if not (r["text"] or "").strip(" \t\n"))
    assert mix_sources(awkward.empty(spark), ["doc_id"]).count() == 0
