import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import crf, fm, langid, toxicity
from tessera.llm.common import held_out
from tests.llm import awkward


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k = int(rng.integers(1, 9)), 3
        emit, step, start = rng.random((n, k)) + 0.1, rng.random((k, k)) + 0.1, rng.random(k) + 0.1
        reset = rng.random(n) < 0.3
        reset[0] = True
        want = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=n):
            p = np.prod([emit[t, c] * (start[c] if reset[t] else step[path[t - 1], c]) for t, c in enumerate(path)])
            want[np.arange(n), path] += p
        alpha, beta = crf.forward_backward(emit, step, start, reset)
        assert np.allclose(crf.normalised(alpha * beta), crf.normalised(want))


def test_long_chains_stay_in_range():
    emit = np.full((200_000, 2), [1.0, 1e-12])
    reset = np.zeros(200_000, bool)
    reset[0] = True
    alpha, beta = crf.forward_backward(emit, np.array([[1, 1e-6], [1e-6, 1]]), np.ones(2), reset)
    p = crf.normalised(alpha * beta)
    assert np.isfinite(p).all() and (p[:, 0] > 0.99).all()


def test_machine_by_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = fm.Machine(0.3, rng.normal(size=10), rng.normal(size=(10, fm.FACTORS)))
    doc, feature, value = np.array([0, 0, 0, 2, 2]), np.array([1, 4, 9, 0, 4]), rng.normal(size=5)
    raw, _ = m.raw(doc, feature, value, 3)
    for d in range(3):
        own = [(f, x) for e, f, x in zip(doc, feature, value) if e == d]
        want = 0.3 + sum(m.linear[f] * x for f, x in own) + sum(
            m.factors[f] @ m.factors[g] * x * y for (f, x), (g, y) in itertools.combinations(own, 2))
        assert raw[d] == pytest.approx(want)


def corpus(spark):
    """Two made languages; toxic documents hold words beginning with grr."""
    rows = []
    for i in range(400):
        lang = ("xa", "xb")[i % 2]
        text = awkward.words(60, i, ("abcde", "klmno")[i % 2])
        toxic = i % 5 == 0
        if toxic:
            text += " grr" + awkward.words(1, i, "pq") + " " + awkward.words(20, i + 999, ("abcde", "klmno")[i % 2])
        quality = int(i % 7 != 0)
        rows.append((i, text if quality else text.upper() + " ### $$$ ###", lang, int(toxic), quality))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int").cache()


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    usable = lambda c: ~held_out(c)
    model = toxicity.fit(fm.labelled_sample(docs, docs, "toxic", usable, 300))
    got = toxicity.score(docs, model, ["doc_id", "toxic", "text"]).where(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["score"] >= 0.3) == r["toxic"] for r in got]) > 0.95
    for r in got:
        raw = r["text"].encode()
        assert all(raw[s["start"]:s["end"]].lower().startswith(b"grr") for s in r["spans"])
    machine = fm.fit(fm.labelled_sample(docs, docs, "quality", usable, 300))
    got = fm.score(docs, machine, ["doc_id", "quality"]).where(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["score"] >= 0.7) == r["quality"] for r in got]) > 0.95
    model = langid.fit(langid.sample(docs, usable, 100))
    got = langid.identify(docs, model, ["doc_id", "lang"]).where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    # switched text: each half keeps its own words
    w = crf.tokens(pa.array([awkward.words(40, 5, "abcde") + " " + awkward.words(40, 6, "klmno")]))
    best = model.field.marginals(w).argmax(1)
    assert (best[:40] == 0).mean() > 0.9 and (best[40:] == 1).mean() > 0.9


def test_labels_of_held_out_rows_and_metadata_do_not_matter(spark):
    docs = corpus(spark)
    usable = lambda c: ~held_out(c)
    other = docs.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = fm.score(docs, fm.fit(fm.labelled_sample(docs, docs, "quality", usable, 300)), ["doc_id"]).collect()
    b = fm.score(docs, fm.fit(fm.labelled_sample(docs, other, "quality", usable, 300)), ["doc_id"]).collect()
    assert sorted(a) == sorted(b)


def test_awkward_rows(spark):
    docs, none = awkward.frame(spark), awkward.empty(spark)
    usable = lambda c: ~held_out(c)
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("toxic"), (F.length("text") % 2).alias("quality"))
    for label, fit, score in (("toxic", toxicity.fit, toxicity.score), ("quality", fm.fit, fm.score)):
        for source in (docs, none):
            model = fit(fm.labelled_sample(source, labels, label, usable, 50))
            rows = score(docs, model, ["doc_id", "score"]).collect()
            assert len(rows) == docs.count() and all(0 <= r[2] <= 1 for r in rows)
            assert score(none, model, ["doc_id"]).count() == 0
    for source in (docs, none):
        model = langid.fit(langid.sample(source, usable, 50))
        rows = langid.identify(docs, model, ["doc_id", "text", "lang"]).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        for r in rows:
            if not any(ch.isalpha() for ch in r["text"] or "") or source is none:
                assert r["lang_pred"] == "und"
            else:
                assert r["lang_pred"] in ("en", "fr")
        assert langid.identify(none, model, ["doc_id"]).count() == 0


def test_n_chars_is_a_feature(spark):
    docs = spark.createDataFrame([(i, "the same text", 20 if i % 2 else 4000, i % 2) for i in range(300)],
                                 "doc_id long, text string, n_chars long, quality int")
    machine = fm.fit(fm.labelled_sample(docs, docs, "quality", lambda c: ~held_out(c), 200))
    got = fm.score(docs, machine, ["doc_id", "quality"]).collect()
    assert all((r["score"] >= 0.5) == bool(r["quality"]) for r in got)
    known = fm.metadata(np.array([0.0, np.nan, -1.0, 99.0]))
    assert known[:, 1].tolist() == [1, 0, 0, 1] and not known[1:3].any()
    unknown = docs.select("doc_id", "text").union(docs.select("doc_id", F.lit(None).cast("string")))
    assert fm.score(unknown, machine, ["doc_id"]).where("score between 0 and 1").count() == 600


def test_copies_and_shared_passages_are_counted_once(spark):
    """A word that only one passage holds, however many toxic documents
    repeat it, marks nothing; one in many contexts does."""
    passage = "alpha uniqueword omega " + awkward.words(40, 500)
    rows = [(i, passage + " " + awkward.words(30, 600 + i), 1) for i in range(40)]
    rows += [(100 + i, f"{awkward.words(15, 900 + i)} horrid {awkward.words(15, 1900 + i)}", 1) for i in range(30)]
    rows += [(200 + i, awkward.words(40, 3000 + i), 0) for i in range(200)]
    rows += [(500, "alpha uniqueword omega", 0)]
    known = toxicity.markers(spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3), 0.25)
    w = crf.tokens(pa.array(["horrid uniqueword"]))
    assert np.isin(toxicity.marker_keys(w), known).all(1).tolist() == [True, False]
    none = spark.createDataFrame([], "doc_id long, text string, label int")
    assert len(toxicity.markers(none, 0.5)) == 0


def test_samples_take_one_row_an_id(spark):
    rows = [(i % 5, f"text {i:03d}", "en" if i % 5 else "fr", 1, i % 2) for i in range(500)] + [(1, None, "en", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, toxic int")
    got = fm.labelled_sample(docs, docs, "toxic", lambda c: c >= 0, 10).collect()
    assert sorted((r["doc_id"], r["text"], r["label"]) for r in got) == [(i, f"text {i:03d}", 1) for i in range(5)]
    got = langid.sample(docs, lambda c: c >= 0, 10).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(i, f"text {i:03d}") for i in range(5)]
