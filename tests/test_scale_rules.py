"""Nothing is dropped, capped or gathered: hot keys, NULLs, one-sided input."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.operators import sequences as sq
from tessera.operators.vectors import dot_softmax_lookup, greedy_match_f1
from tessera.plans import fixtures as fx
from tessera.plans.ranking import global_rank, grouped_rank
from tessera.session import get_session
from tessera.sources import ledger, splits


def test_session_keeps_the_callers_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert get_session(shuffle_partitions=8).conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbering_with_a_user_of_a_third_of_the_events(spark, tmp_path):
    ev = spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 37 % 200_000).alias("ts"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 11).cast("double").alias("value"), F.lit('{"k": 3}').alias("props"))
    ev.write.parquet(f"{tmp_path}/events.parquet")
    log = fx.train_log(spark, str(tmp_path), ("micro", "step"))
    step = F.row_number().over(Window.partitionBy("run_id").orderBy("ts", "event_id"))
    micro = F.row_number().over(Window.partitionBy("run_id", "epoch").orderBy("ts", "event_id"))
    assert log.count() == 3000
    wrong = log.withColumn("s", step).withColumn("m", micro).filter("s <> step or m <> micro")
    assert wrong.count() == 0
    every = fx.samples(spark, str(tmp_path))
    first = fx.samples(spark, str(tmp_path), most=10)
    assert sorted(map(repr, first.collect())) == sorted(map(repr, every.where("sample_idx < 10").collect()))


def test_ranks_with_null_groups_and_ties(spark):
    rows = [(None, 3, 1), (None, 1, 2), ("a", 1, 3), ("a", 1, 4), (None, 2, 5), ("b", None, 6), ("b", 0, 7)]
    df = spark.createDataFrame(rows, "g string, o int, id int")
    want = {1: 2, 2: 0, 3: 0, 4: 1, 5: 1, 6: 0, 7: 1}
    got = grouped_rank(df, ["g"], ["o", "id"], F.floor(F.col("o") / 2), "r")
    assert {r["id"]: r["r"] for r in got.collect()} == want
    assert {r["id"]: r["rank"] for r in global_rank(df, ["o", "id"], ["g"]).collect()} == want


def test_head_sample_keeps_rows_without_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (5,), (1,), (2,), (2,), (9,)], "v int")
    for n in range(10):
        got = sorted((r["v"] for r in sampling.head_sample(df, "v", n).collect()), key=lambda v: (v is None, v or 0))
        assert got == [1, 2, 2, 5, 9, None, None, None][:n]


def test_one_sided_pairs_and_zero_vectors_score_zero(spark):
    rows = [(1, 0, 0, [1.0, 0.0]), (2, 1, 0, [1.0, 0.0]), (3, 0, 0, [0.0, 0.0]), (3, 1, 1, [1.0, 0.0]),
            (4, 0, 0, [2.0, 0.0]), (4, 1, 1, [5.0, 0.0])]
    tv = spark.createDataFrame(rows, "pair_id long, side int, pos long, vec array<double>")
    for small in (64, 0):
        got = {r["pair_id"]: (r["precision"], r["recall"], r["f1"]) for r in greedy_match_f1(tv, small=small).collect()}
        assert got == {1: (0, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (1, 1, 1)}


def test_causal_blocks_give_the_same_values(spark):
    rows = [(g, p, [float((g * 7 + p * k) % 5) for k in range(1, 5)]) for g in range(3) for p in range(40)]
    qkv = spark.createDataFrame(rows, "grp long, pos long, vec array<double>")
    cols = ["grp", "pos", "n_keys", "max_weight", "out_dot_q", "out_sum"]
    for causal in (True, False):
        small, whole = (dot_softmax_lookup(qkv, causal, block=b).orderBy("grp", "pos").collect() for b in (7, 1000))
        for a, b in zip(small, whole):
            assert all(a[c] == pytest.approx(b[c]) for c in cols) and a["out"] == pytest.approx(b["out"])
    bare = dot_softmax_lookup(qkv, block=7, with_vector=False)
    assert bare.columns == cols and bare.count() == 120


def test_lookups_share_a_join(spark):
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    df = spark.createDataFrame([(1, ["a", "x", "b"], ["b"]), (2, [], None)], "id long, s array<string>, t array<string>")
    got = {r["id"]: (r["si"], r["ti"]) for r in sq.lookup_ids(df, "id", {"s": "si", "t": "ti"}, vocab).collect()}
    assert got == {1: ([4, 0, 5], [5]), 2: ([], [])}
    assert sq.lookup_ids(df, "id", "s", vocab, most=2).orderBy("id").first()["ids"] == [4, 0]


def test_stamps_and_split_folder(spark, tmp_path):
    r = spark.sql("select timestamp'2025-03-04 05:06:07.000089' t").select(
        ledger.stamp_compact("t").alias("a"), ledger.stamp_utc("t").alias("b")).first()
    assert (r["a"], r["b"]) == ("20250304_050607", "2025-03-04T05:06:07.000089+00:00")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "x long, split string")
    splits.write_split_dataset(df, str(tmp_path / "ds"))
    back = splits.read_split_dataset(spark, str(tmp_path / "ds"), required=["train"])
    assert [(r["x"], r["split"]) for r in back.collect()] == [(1, "train")]
    with pytest.raises(ValueError):
        splits.read_split_dataset(spark, str(tmp_path / "ds"), required=["validation"])


def test_every_term_reaches_the_vectorizer(spark):
    from tessera.operators import linear

    words = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    df = spark.createDataFrame([(words(i), i % 2) for i in range(20)], "text string, label int")
    assert len(linear.mllib_fit(df, max_iter=1).stages[1].vocabulary) == 800
