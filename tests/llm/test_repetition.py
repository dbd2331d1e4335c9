import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import repetition as R
from tests.llm import awkward


def longest(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=25), min_size=1, max_size=4))
def test_longest_repeats_by_brute_force(texts):
    data, offsets = R.text_buffer(pa.array([" ".join(t) for t in texts]))
    w = R.Words(data, offsets)
    end = w.first[w.doc + 1] if len(w) else np.zeros(0, np.int64)
    assert R.longest_repeats(R.in_doc(w.hashes(), w.doc), end).tolist() == sum(map(longest, texts), [])


def test_measures_and_verdict(spark):
    twice = awkward.words(120, 1)
    docs = spark.createDataFrame([
        (1, "a b c d e f g h i j k"), (2, "few words"), (3, None), (4, ""), (5, "x " * 400),
        (6, awkward.words(3000, 2) + " " + twice + " " + awkward.words(20, 3) + " " + twice),
        (7, "# one line of nine words is here now ok\nother\n# one line of nine words is here now ok\n\n"),
    ], "doc_id long, text string")
    got = {r["doc_id"]: r for r in R.repetition(docs).collect()}
    assert got[1]["kept"] and not got[1]["base_failed"] and got[1]["word_chars"] == 11
    assert got[2]["base_failed"] and got[3]["n_words"] == got[4]["n_words"] == 0 and not got[3]["kept"]
    assert got[5]["longest_repeat"] == 399 and got[5]["n_repeat_words"] == 400 and not got[5]["kept"]
    # 240 of 3260 words pass the base rule; the repeat of 120 words does not pass the longest one
    assert got[6]["longest_repeat"] == 120 and not got[6]["base_failed"] and not got[6]["kept"]
    assert [(r["start"], r["words"]) for r in got[6]["repeats"]] == [(3000, 120), (3140, 120)]
    assert got[7]["n_dup_lines"] == 1 and got[7]["n_symbols"] == 2


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    out = R.repetition(docs)
    assert out.count() == docs.count()
    assert R.repetition(awkward.empty(spark)).count() == 0
    per = {r["doc_id"]: r["n_words"] for r in out.collect()}
    assert per[5] == 30_000 and per[2] == per[3] == per[4] == 0 and per[10] == 1
