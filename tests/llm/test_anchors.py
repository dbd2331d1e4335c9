import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import anchors
from tests.llm import awkward


def brute(docs, window=50):
    """(n_words, n_removed, kept) of each (id, text)."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for a in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[a:a + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - window + 1) if i is not None else ():
            if least[tuple(w[a:a + window])] < i:
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_cover():
    d = anchors.COVER
    assert sorted((a - b) % anchors.PERIOD for a in d for b in d if a != b) == list(range(1, anchors.PERIOD))


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in anchors.substring_dedup(df, ["doc_id"]).collect()]
    assert sorted(got, key=repr) == brute(docs)


def test_shifted_passages_by_brute_force(spark):
    rng = random.Random(4)
    passages = [awkward.words(n, 50 + n) for n in (49, 50, 51, 64, 90, 200)]
    docs = []
    for i in range(60):
        parts = [awkward.words(rng.randint(0, 60), 1000 + 10 * i + k) if k % 2 else rng.choice(passages) for k in range(rng.randint(1, 5))]
        docs.append((rng.choice([i, i, i, None]), " ".join(parts)))
    docs += [(200, docs[0][1]), (200, docs[0][1]), (200, docs[1][1]), (201, "z " * 300), (202, "z " * 120), (203, "z " * 49)]
    check(spark, docs)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.sampled_from("ab"), max_size=160)), max_size=8))
def test_small_alphabet_by_brute_force(spark, texts):
    check(spark, [(i, " ".join(t)) for i, t in texts])


def test_blocks_settle_alike(spark, monkeypatch):
    docs = [(i, awkward.words(30, i) + " " + awkward.words(80, i % 3 + 500) + " " + awkward.words(30, i + 900)) for i in range(40)]
    check(spark, docs)


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = anchors.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    whole = anchors.substring_dedup(docs, ["doc_id", "text"], verbatim=True).where("n_removed = 0").collect()
    assert all(r["kept"] == r["text"] for r in whole)
    assert anchors.substring_dedup(awkward.empty(spark)).count() == 0
