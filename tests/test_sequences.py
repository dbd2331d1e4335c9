"""Sequence encoding golden cases and round trips."""

from pyspark.sql import functions as F

from tessera.operators import sequences as sq


def py_instruction(p, y, max_len, pad=sq.PAD, eos=sq.EOS):
    """The reference's truncation rule, written directly."""
    if not y or y[-1] != eos:
        y = y + [eos]
    ids, lab = p + y, [-100] * len(p) + y
    if len(ids) > max_len:
        cut = len(ids) - max_len
        if cut < len(y):
            y = y[cut:]
            ids, lab = p + y, [-100] * len(p) + y
        else:
            ids, lab = ids[-max_len:], lab[-max_len:]
    n = max_len - len(ids)
    return ids + [pad] * n, [1] * len(ids) + [0] * n, lab + [-100] * n


def test_encode_instruction_cases(spark):
    cases = [
        ([10, 11], [20, 21, 22], 8),          # fits
        ([10, 11], [20, 21, 22, 23, 24, 25, 26], 8),   # target too long: trim its start
        ([10, 11, 12, 13, 14, 15, 16, 17, 18], [20], 8),  # prompt too long: keep the tail
        ([10, 11], [20, 21, 22, 23, 24], 8),  # exactly at the limit with EOS
        ([], [], 4),
    ]
    for p, y, n in cases:
        df = spark.createDataFrame([(1, p, y)], "id int, p array<int>, y array<int>")
        r = sq.encode_instruction(df, "p", "y", n).first()
        ids, mask, lab = py_instruction(p, y, n)
        assert (r["input_ids"], r["attention_mask"], r["labels"]) == (ids, mask, lab), (p, y, n)


def test_vocab_and_roundtrip(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c", "b"]), (3, [])], "id long, t array<string>")
    occ = docs.select(F.explode("t").alias("token"))
    vocab = sq.build_vocab(occ)
    got = {r["token"]: r["id"] for r in vocab.collect()}
    assert got == {"<unk>": 0, "<pad>": 1, "<bos>": 2, "<eos>": 3, "b": 4, "a": 5, "c": 6}
    ids = sq.lookup_ids(docs, "id", "t", vocab)
    rows = {r["id"]: r["ids"] for r in ids.collect()}
    assert rows == {1: [4, 5, 4], 2: [6, 4], 3: []}
    wrapped = ids.select("id", sq.wrap_truncate(F.col("ids"), 4).alias("w"))
    dec = {r["id"]: r["text"] for r in sq.decode(wrapped, "id", "w", vocab).collect()}
    assert dec == {1: "b a", 2: "c b", 3: ""}


def test_unknown_only(spark):
    vocab = sq.build_vocab(spark.createDataFrame([("x",)], "token string"))
    docs = spark.createDataFrame([(1, ["zzz"])], "id long, t array<string>")
    assert sq.lookup_ids(docs, "id", "t", vocab).first()["ids"] == [0]


def test_teacher_forcing_fixed_and_labels(spark):
    df = spark.createDataFrame([([2, 7, 8, 3, 1],)], "ids array<int>")
    i, lab = sq.teacher_forcing(F.col("ids"))
    r = df.select(i.alias("i"), lab.alias("l"), sq.collator_labels(F.col("ids")).alias("c"),
                  sq.valid_tokens(sq.collator_labels(F.col("ids"))).alias("v")).first()
    assert r["i"] == [2, 7, 8, 3] and r["l"] == [7, 8, 3, 1]
    assert r["c"] == [2, 7, 8, 3, -100] and r["v"] == 4
    ids, mask, tt = sq.encode_fixed(F.array(*[F.lit(x) for x in range(10, 20)]), 6)
    r = spark.range(1).select(ids.alias("a"), mask.alias("m"), tt.alias("t")).first()
    assert r["a"] == [2, 10, 11, 12, 13, 3] and r["m"] == [1] * 6 and r["t"] == [0] * 6
