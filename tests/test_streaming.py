"""Encoding and prompts on file streams; the per-row vocabulary lookup."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import sequences as sq, vocab as pv
from tessera.plans import q_sequences, q_stream
from tessera.sources.tables import read_table
from tessera.streaming.rowwise import read_table_stream, run_batches

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """``documents`` as a folder of several part files."""
    folder = str(tmp_path_factory.mktemp("parts"))
    read_table(spark, SF, "documents").repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_encoding_on_a_stream_equals_the_batch(spark, parts):
    _, vocab = q_sequences.doc_vocab(spark, SF)
    batch = rows(q_stream.rowwise_encoder(vocab)(read_table(spark, SF, "documents")))
    assert rows(q_stream.q_stream_encode(spark, parts)) == batch
    lookup = {r["doc_id"]: r["ids_md5"] for r in q_sequences.q_vocab_lookup(spark, SF).collect()}
    assert {r[0]: r[3] for r in batch} == lookup


def test_large_vocabularies_are_joined_batch_by_batch(spark, parts):
    _, vocab = q_sequences.doc_vocab(spark, SF)
    assert pv.pack(vocab, 100) is None
    with pytest.raises(ValueError):
        pv.need_packed(vocab, 100)
    got = run_batches(spark, read_table_stream(spark, parts, "documents"), q_stream.joined_encoder(vocab))
    assert rows(got) == rows(q_stream.rowwise_encoder(vocab)(read_table(spark, SF, "documents")))


def test_prompts_on_a_stream_equal_the_batch(spark):
    got = rows(q_stream.q_stream_prompts(spark, SF))
    assert got and got == rows(q_stream.prompt_transform(read_table(spark, SF, "benchmark")))


CASES = [(1, ["a", "b", "zz"]), (1, ["b"]), (1, ["b"]), (2, []), (3, None), (None, ["c", None, "a"]), (4, ["<unk>", "é", ""])]


@pytest.mark.parametrize("most_bytes", [0, 1 << 20])
def test_lookup_of_awkward_rows(spark, most_bytes):
    """Keys that repeat or are NULL, empty and NULL arrays, NULL tokens."""
    vocab = spark.createDataFrame([("<unk>", 0), ("a", 4), ("b", 5), ("c", 6), ("é", 7), ("", 8)], "token string, id int")
    known = {r["token"]: r["id"] for r in vocab.collect()}
    df = spark.createDataFrame(CASES, "k long, t array<string>")
    got = [(r["k"], r["ids"]) for r in sq.lookup_ids(df, "k", "t", vocab, most_bytes=most_bytes).collect()]
    assert sorted(got, key=repr) == sorted(((k, [known.get(x, 0) for x in t or []]) for k, t in CASES), key=repr)
    short = sq.lookup_ids(df, "k", {"t": "x"}, vocab, most=1, most_bytes=most_bytes)
    assert max(r["x"] for r in short.select(F.size("x").alias("x")).collect()) == 1
    none = sq.lookup_ids(df, "k", "t", vocab.limit(0), most_bytes=most_bytes)
    assert all(x == 0 for r in none.collect() for x in r["ids"])
    assert sq.lookup_ids(df.limit(0), "k", "t", vocab, most_bytes=most_bytes).count() == 0


def test_frequent_tokens_row_by_row_and_rare_ones_joined(spark, monkeypatch):
    """A vocabulary over the bound: some of its tokens are broadcast, the
    others joined, whichever a row has of them."""
    most_bytes, long = 800, "l" * 70
    known = {"<unk>": 0, **{f"t{i}": i for i in range(4, 40)}, long: 3, "é": 40}
    vocab = spark.createDataFrame([*known.items(), (None, 99)], "token string, id int")
    rng = random.Random(5)
    pool = [*known, "x", "y", None]
    cases = [(rng.choice([1, 2, None]), [rng.choice(pool) for _ in range(rng.randint(0, 12))], [rng.choice(pool[:6])]) for _ in range(40)]
    cases += [cases[0], cases[0], (3, None, [long, long]), (4, ["t4", "t5"], None), (5, [], []), (6, ["x", "t39", "x"], ["y"])]
    df = spark.createDataFrame(cases, "k long, s array<string>, t array<string>").repartition(3)
    packed, pack = [], pv.pack
    monkeypatch.setattr(pv, "pack", lambda *a: packed.append(pack(*a)) or packed[-1])
    out = sq.lookup_ids(df, "k", {"s": "si", "t": "ti"}, vocab, most_bytes=most_bytes)
    assert out.columns == ["k", "s", "t", "si", "ti"]
    got = [tuple(r) for r in out.collect()]
    want = [(k, s, t, *([known.get(x, 0) for x in a or []] for a in (s, t))) for k, s, t in cases]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    held = [len(p.value.ids) for p in packed if p is not None]
    assert held and 0 < max(held) <= most_bytes // (20 + pv.TOKEN_BYTES)
    twice = vocab.withColumn("id", F.lit(1))  # ids that repeat: none is taken for frequent
    ones = sq.lookup_ids(df, "k", "s", twice, most_bytes=most_bytes, keep=["k"])
    assert ones.columns == ["k", "ids"]
    assert sorted(map(repr, map(tuple, ones.collect()))) == sorted(repr((k, [int(x in known) for x in s or []])) for k, s, _ in cases)


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(pv, "SLICE_TOKENS", 3)
    rows = [["a"], None, ["b", "c"], ["d"] * 7, [], ["e", None, "f"], ["g"]]
    parts = [p.to_pylist() for p in pv.slices(pa.array(rows, pa.list_(pa.string())))]
    assert sum(parts, []) == rows
    assert all(len(p) == 1 or sum(len(x or []) for x in p) <= 3 for p in parts) and len(parts) < len(rows)
    assert list(pv.slices(pa.array([], pa.list_(pa.string())))) == []


def test_decode_keeps_rows_of_one_key_apart(spark):
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    df = spark.createDataFrame([(1, [2, 4, 5, 3, 4]), (1, [5]), (1, [5]), (2, [9]), (None, [4])], "k long, ids array<int>")
    got = sorted(((r["k"], r["text"]) for r in sq.decode(df, "k", "ids", vocab).collect()), key=repr)
    assert got == sorted([(1, "a b"), (1, "b"), (1, "b"), (2, "<unk>"), (None, "a")], key=repr)


def test_tokens_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(pv.PackedVocab, "hash", staticmethod(lambda tokens: np.array([len(t) for t in tokens.to_pylist()], np.uint64)))
    table = pv.PackedVocab(pa.array(["aa", "b", "cc", "dd"]), np.array([4, 5, 6, 7]))
    assert table.widest == 3
    assert table.look_up(pa.array(["dd", "aa", "xx", "b", "c", "ccc"]), 0).tolist() == [7, 4, 0, 5, 0, 0]


def test_lookup_plans_shuffle_no_texts(spark):
    """T3 and T6 read texts in the scan's splits only."""
    for q in (q_sequences.q_vocab_lookup, q_stream.q_stream_encode):
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(doc_id" not in plan
