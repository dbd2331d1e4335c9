"""Toxic spans with a linear-chain conditional random field.

Document labels are turned into labelled words: a word or word beginning
that occurs in many toxic and few clean documents marks its words as
toxic.  The field learns the two labels from runs of words
around marked and unmarked places; its affix and trigram features carry
over to forms not seen.  Forward-backward marginals are summed up for
each document (largest, mass, share), a logistic function fitted on the
sample's document labels gives the score, and words above the threshold
give the offending offsets.

Learning uses a sample of labelled documents whose size is a parameter
(the smallest id hashes); scoring reads whole texts.  Within the sample a
word counts once in each context (itself and its neighbours), so that a
large group of copies or a passage that many documents share does not make
its words look toxic.

Defined results: null and empty texts get the score of a document
without words and no spans; repeated rows get equal results; an empty
table gives an empty result; null ids and null labels are not learned
from; without toxic words in the sample every score is the toxic share.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import crf
from tessera.llm.bytetext import BASE_B, Slices, Words, chunks
from tessera.llm.common import pick, written
from tessera.session import ship_package

BEGINNINGS = (4, 5, 6)
#: Share of the markers that chance may account for.
FALSE_SHARE = 0.2


@dataclasses.dataclass
class Model:
    field: crf.Field
    slope: np.ndarray  # of the document summary
    bias: float


def marker_keys(w: Words) -> np.ndarray:
    """For each word the hashes of itself and of its beginnings (one
    column each; short words repeat themselves)."""
    cut = w.slices()
    whole = cut.hash(w.start, w.end)
    return np.stack([whole, *(np.where(w.end - w.start > n, cut.hash(w.start, np.minimum(w.start + n, w.end)), whole) for n in BEGINNINGS)], 1)


def contexts(w: Words) -> np.ndarray:
    """For each word the hash of it and its neighbours (those there are)."""
    at = np.arange(len(w))
    if not len(w):
        return np.zeros(0, np.uint64)
    return Slices(w.hashes(), BASE_B).hash(np.maximum(at - 1, w.first[w.doc]), np.minimum(at + 2, w.first[w.doc + 1]))


def markers(rows: DataFrame, rate: float) -> np.ndarray:
    """Sorted hashes that mark toxic words: twelve in thirteen of the
    documents that count for one are toxic, and of those as surprising or more
    chance (the toxic share to the power of the toxic ones, times the ways to
    pick the clean ones) would give no more than FALSE_SHARE.

    A word in its context (its neighbours) counts for one document, the one
    with the smallest id, and as clean if any clean document holds it: what
    copies and shared passages repeat is no further evidence."""
    def run(batches):
        for batch in chunks(batches, "text"):
            w = crf.tokens(batch.column(1))
            keys = marker_keys(w)
            # shorter beginnings repeat the word: once is enough
            first = np.ones(keys.shape, bool)
            for c in range(1, keys.shape[1]):
                first[:, c] = (keys[:, c, None] != keys[:, :c]).all(1)
            place, _ = np.nonzero(first)
            flat, context, doc = keys[first], contexts(w)[place], w.doc[place]
            by = np.lexsort((context, flat, doc))
            flat, context, doc = flat[by], context[by], doc[by]
            new = np.ones(len(flat), bool)
            new[1:] = (flat[1:] != flat[:-1]) | (context[1:] != context[:-1]) | (doc[1:] != doc[:-1])
            flat, context, doc = flat[new], context[new], doc[new]
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(context.view(np.int64)),
                                              batch.column(0).take(pa.array(doc)), batch.column(2).take(pa.array(doc))], ["word", "context", "doc", "label"])

    places = rows.mapInArrow(run, "word long, context long, doc long, label int")
    once = places.groupBy("word", "context").agg(F.min("doc").alias("doc"), F.min("label").alias("label"))
    held = once.groupBy("word", "doc").agg(F.max("label").alias("label"))
    seen = held.groupBy("word").agg(F.sum("label").alias("bad"), F.count("*").alias("n")).where("n >= 3")
    good = F.col("n") - F.col("bad")
    ways = good * F.log(F.col("n") * math.e / F.greatest(good, F.lit(1)))
    surprise = F.col("bad") * math.log(1 / min(max(rate, 0.01), 0.9)) - ways
    seen = written(seen.withColumn("surprise", surprise), "markers")
    pure = seen.where((F.col("bad") >= 3) & (12 * good <= F.col("bad")) & (F.col("surprise") > 0))
    # how many reach each eighth of a surprise: a short table whatever the sample
    steps = pure.groupBy(F.floor(F.least(F.col("surprise"), F.lit(100)) * 8).alias("s")).agg(F.count("*").alias("c")).orderBy(F.desc("s")).collect()
    tests, reached, least = seen.count(), 0, None
    for row in steps:
        reached += row["c"]
        if tests * math.exp(-row["s"] / 8) <= FALSE_SHARE * reached:
            least = row["s"] / 8
    if least is None:
        return np.zeros(0, np.uint64)
    got = pure.where(F.col("surprise") >= least).select("word").collect()
    return np.sort(np.array([r["word"] for r in got], np.int64).view(np.uint64))


def marked(w: Words, known: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Words of toxic documents that a marker names."""
    keys = marker_keys(w)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return (known[place] == keys).any(1) & (toxic[w.doc] > 0)


def runs_of(rows: DataFrame, known: np.ndarray, length: int, most: int, seed: int) -> DataFrame:
    """(doc_id, run, labels): for each document a run of words around a
    random place and up to ``most`` around marked words."""
    def run(batches):
        for batch in chunks(batches, "text"):
            w, out = crf.tokens(batch.column(1)), []
            label = marked(w, known, batch.column(2).to_numpy())
            for i, doc in enumerate(batch.column(0).to_pylist()):
                a, b = int(w.first[i]), int(w.first[i + 1])
                rng = np.random.default_rng([seed, doc & 0xFFFFFFFF, b - a])
                hits = a + np.flatnonzero(label[a:b])
                for centre in [*(rng.integers(a, b, 1) if b > a else []), *rng.permutation(hits)[:most]]:
                    lo = max(a, int(centre) - int(rng.integers(0, length)))
                    hi = min(b, lo + length)
                    out.append((doc, crf.joined(w, lo, hi), label[lo:hi].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["doc_id", "run", "labels"])

    return rows.mapInArrow(run, "doc_id long, run string, labels binary")


def summary(p: np.ndarray, w: Words, n: int) -> np.ndarray:
    """(n, 3): logit of the largest marginal, log of their sum, log of
    their mean."""
    most, mass = np.full(n, 1e-6), np.full(n, 1e-6)
    np.maximum.at(most, w.doc, p)
    mass += np.bincount(w.doc, p, n)
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(most / (1 - most)), np.log(mass), np.log(mass / np.maximum(np.diff(w.first), 1))], 1) / 5


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Newton's method on the penalised logistic loss."""
    z = np.concatenate([x, np.ones((len(x), 1))], 1)
    b = np.zeros(z.shape[1])
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -35, 35)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + l2 * len(x) * np.eye(len(b)) + 1e-9
        move = np.linalg.solve(hess, z.T @ (y - p) - l2 * len(x) * np.append(b[:-1], 0))
        b += np.clip(move, -5, 5)
    return b[:-1], float(b[-1])


def fit(rows: DataFrame, length: int = 24, most: int = 3, seed: int = 11) -> Model:
    """Learn from a bounded sample (doc_id, text, label).  Words are
    counted, marked and summed up on the executors, over whole texts; what
    the field is fitted on reaches the driver: 1 + ``most`` runs of
    ``length`` words a document at most."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.select("doc_id", F.col("text"), F.col("label").cast("int").alias("label")).where("text is not null")
    share = rows.agg(F.avg("label")).first()[0]
    rate = float(np.clip(0.5 if share is None else share, 0.01, 0.99))
    known = markers(rows, rate)
    if not len(known):
        return Model(crf.Field(np.zeros((crf.BUCKETS + 1, 2)), np.zeros((2, 2)), np.zeros(2), [known]),
                     np.zeros(3), float(np.log(rate / (1 - rate))))
    got = sorted((r["doc_id"], r["run"], bytes(r["labels"])) for r in runs_of(rows, known, length, most, seed).collect())
    w = crf.tokens(pa.array([r[1] for r in got]))
    reset = np.zeros(len(w), bool)
    reset[w.first[:-1][np.diff(w.first) > 0]] = True
    labels = np.frombuffer(b"".join(r[2] for r in got), np.uint8).astype(np.int64)
    field = crf.fit(w, np.arange(len(w)), reset, labels, 2, [known])

    shared = spark.sparkContext.broadcast(field)

    def summed(batches):
        for batch in chunks(batches, "text"):
            w = crf.tokens(batch.column(1))
            x = summary(shared.value.marginals(w)[:, 1], w, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, x.T)], ["doc_id", "label", "a", "b", "c"])

    table = rows.mapInArrow(summed, "doc_id long, label int, a double, b double, c double").toPandas().sort_values(["doc_id", "a"])
    return Model(field, *logistic(table[["a", "b", "c"]].to_numpy(), table["label"].to_numpy().astype(float)))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` and score, n_toxic and spans (byte offsets in
    UTF-8, with the word's marginal) of every whole text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    source = pick(docs, **{f"c{i}": c for i, c in enumerate(keep)}, text_=text)

    def run(batches):
        m = shared.value
        for batch in chunks(batches, "text_"):
            w = crf.tokens(batch.columns[-1])
            p = m.field.marginals(w)[:, 1]
            raw = summary(p, w, batch.num_rows) @ m.slope + m.bias
            hit = np.flatnonzero(p >= threshold)
            base = w.offsets[w.doc[hit]]
            spans = pa.StructArray.from_arrays([pa.array(w.start[hit] - base), pa.array(w.end[hit] - base), pa.array(p[hit])], ["start", "end", "p"])
            first = np.searchsorted(hit, w.first)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35)))), pa.array(np.diff(first)),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans)],
                [*batch.schema.names[:-1], "score", "n_toxic", "spans"])

    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), F.lit(0.0).alias("p")))
    schema = source.drop("text_").withColumns({"score": F.lit(0.0), "n_toxic": F.lit(0).cast("long"), "spans": span}).schema
    return source.mapInArrow(run, schema).toDF(*keep, "score", "n_toxic", "spans")
