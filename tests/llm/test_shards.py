import zlib

from tessera.llm.shards import shard_documents
from tests.llm import awkward


def check(rows, texts, shards):
    """Digests, gapless slots and the law's evenness."""
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by.items()}


def test_even_shards_that_keep_groups(spark):
    docs = [(i, awkward.words(20 + i % 60, i % 700)) for i in range(3000)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string"), 12).collect()
    assert len(rows) == 3000
    texts = dict(docs)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
    weights = check(rows, texts, 12)
    mean = sum(weights.values()) / 12
    assert len(weights) == 12 and all(abs(w - mean) < 0.05 * mean for w in weights.values())
    home = {}
    for r in rows:
        home.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in home.values()) <= 11  # one group at most at each split


def test_a_hot_group_is_cut(spark):
    docs = [(i, "same text over and over") for i in range(900)] + [(i, awkward.words(5, i)) for i in range(900, 1500)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string"), 8).collect()
    weights = check(rows, None, 8)
    mean = sum(weights.values()) / 8
    assert all(abs(w - mean) < 0.1 * mean for w in weights.values())


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    rows = shard_documents(docs, 4).collect()
    assert len(rows) == docs.count()
    check(rows, None, 4)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {16}
    assert shard_documents(awkward.empty(spark), 4).count() == 0
    one = shard_documents(docs.limit(1), 40).collect()
    assert len(one) == 1 and one[0]["slot"] == 0
