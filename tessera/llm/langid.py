"""Language identification of code-switched text with a linear-chain
conditional random field.

Every word gets a label: affix, byte-trigram and lexicon features score
it, learned transitions tie it to its neighbours, forward-backward gives
its marginals.  The mean marginals over the words are the text's mixture
of languages; the largest names its language.

Learning uses a sample whose size is a parameter: for each language the
``per_lang`` documents with the smallest id hashes, and of them runs of
words, every other one spliced from two documents so that transitions
between languages are learned as well.  Prediction reads whole texts.

Defined results: texts that are null or have no letter are ``und`` with
score 0, as is everything if nothing could be learned; ties go to the
smaller language by code point; repeated rows get equal results; an
empty table gives an empty result; null ids and null languages are not
learned from.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import crf
from tessera.llm.bytetext import chunks
from tessera.llm.common import pick
from tessera.session import ship_package


@dataclasses.dataclass
class Model:
    langs: list[str]
    field: crf.Field


def sample(docs: DataFrame, usable, per_lang: int, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, text, lang) of at most ``per_lang`` documents a language;
    the sample of ids is broadcast: its bound is per_lang x languages.  Of
    rows that repeat an id and language the smallest text is taken."""
    all_ = pick(docs, doc_id=doc_id, lang=lang, text=text)
    able = all_.where("doc_id is not null and lang is not null").where(usable(F.col("doc_id"))).select("doc_id", "lang").distinct()
    # a first draw by hash leaves about four times the sample of a language for the exact one
    order = F.xxhash64("doc_id")
    share = able.groupBy("lang").agg((4 * per_lang / F.count("*")).alias("share")).withColumnRenamed("lang", "l")
    drawn = able.join(share, F.col("lang") == F.col("l")).where(order.cast("double") < (F.col("share") * 2 - 1) * float(1 << 63))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    chosen = drawn.select("doc_id", "lang", rank.alias("n")).where(F.col("n") <= per_lang).select("doc_id", "lang")
    rows = all_.where("text is not null").join(F.broadcast(chosen), ["doc_id", "lang"])
    return rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang")


def lexicons(rows: DataFrame, most: int) -> DataFrame:
    """(lang, word): the ``most`` most frequent word hashes of each
    language that are its own to 9 parts in 10."""
    def run(batches):
        for batch in chunks(batches, "text"):
            w = crf.tokens(batch.column(0))
            for name in pc.unique(batch.column(1)).to_pylist():
                own = np.flatnonzero(np.asarray(pc.equal(batch.column(1), name)))
                words, n = np.unique(w.hashes()[np.isin(w.doc, own)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(words), pa.string()), pa.array(words.view(np.int64)), pa.array(n)], ["lang", "word", "n"])

    per = rows.select("text", "lang").mapInArrow(run, "lang string, word long, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    total = per.groupBy("word").agg(F.max(F.struct("n", "lang")).alias("top"), F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    return (total.where("top.n >= 3 and 10 * top.n >= 9 * n").select(F.col("top.lang").alias("lang"), F.col("top.n").alias("n"), "word")
            .withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "word"))


def runs_of(rows: DataFrame, per_doc: int, length: int, seed: int) -> DataFrame:
    """(lang, doc_id, run): runs of at most ``length`` words from random
    places of each document."""
    def run(batches):
        for batch in chunks(batches, "text"):
            w, out = crf.tokens(batch.column(1)), []
            for i, (doc, lang) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                a, b = int(w.first[i]), int(w.first[i + 1])
                rng = np.random.default_rng([seed, doc & 0xFFFFFFFF, b - a])
                for _ in range(per_doc if b > a else 0):
                    n = min(int(rng.integers(length // 4, length + 1)), b - a)
                    at = int(rng.integers(a, b - n + 1))
                    out.append((lang, doc, crf.joined(w, at, at + n)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["lang", "doc_id", "run"])

    return rows.select("doc_id", "text", "lang").mapInArrow(run, "lang string, doc_id long, run string")


def fit(rows: DataFrame, per_doc: int = 4, length: int = 24, lexicon: int = 400, seed: int = 5) -> Model:
    """Learn from a bounded sample (doc_id, text, lang).  The driver gets
    ``per_doc`` runs a document and ``lexicon`` words a language."""
    ship_package(rows.sparkSession)
    got = sorted((r["lang"], r["doc_id"], r["run"]) for r in runs_of(rows, per_doc, length, seed).collect())
    langs = sorted({r[0] for r in got}, key=lambda s: s.encode())
    if not got:
        return Model([], crf.Field(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), []))
    own: dict[str, list[int]] = {name: [] for name in langs}
    for r in lexicons(rows, lexicon).collect():
        own[r["lang"]].append(r["word"])
    # languages in equal parts; of each four runs the last continues the third
    rng = np.random.default_rng(seed)
    of = [[r[2] for r in got if r[0] == name] for name in langs]
    picks = rng.permutation([(c, int(i)) for c, texts in enumerate(of) for i in rng.integers(0, len(texts), -(-len(got) // len(langs)))])
    w = crf.tokens(pa.array([of[c][i] for c, i in picks]))
    begins = np.flatnonzero((np.arange(len(picks)) % 4 != 3) & (np.diff(w.first) > 0))
    reset = np.zeros(len(w), bool)
    reset[w.first[begins]] = reset[:1] = True
    sets = [np.sort(np.array(own[name], np.int64).view(np.uint64)) for name in langs]
    return Model(langs, crf.fit(w, np.arange(len(w)), reset, picks[w.doc, 0], len(langs), sets))


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and lang_pred, score and mixture (the mean
    marginal of each language) of every whole text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    source = pick(docs, **{f"c{i}": c for i, c in enumerate(keep)}, text_=text).withColumn("letters_", F.coalesce(F.col("text_").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        m = shared.value
        for batch in chunks(batches, "text_"):
            n, k = batch.num_rows, len(m.langs)
            mix = np.zeros((n, k))
            if k:
                w = crf.tokens(batch.column(batch.num_columns - 2))
                p = m.field.marginals(w)
                mix = np.stack([np.bincount(w.doc, p[:, c], n) for c in range(k)], 1)
                mix /= np.maximum(mix.sum(1, keepdims=True), 1e-300)
            known = batch.columns[-1].to_numpy(zero_copy_only=False) & (mix.sum(1) > 0.5)
            best = mix.argmax(1) if k else np.zeros(n, int)
            names = [m.langs[b] if ok else "und" for b, ok in zip(best, known)]
            score = np.where(known, np.minimum(mix.max(1, initial=0), 1), 0.0)
            table = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(mix.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names), pa.array(score), table],
                                             [*batch.schema.names[:-2], "lang_pred", "score", "mixture"])

    schema = source.drop("text_", "letters_").withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "mixture": F.array(F.lit(0.0))}).schema
    return source.mapInArrow(run, schema).toDF(*keep, "lang_pred", "score", "mixture")
