"""Factorisation machine over hashed words, structure statistics and
metadata of a text.  The metadata is ``n_chars``; language, source, id
and labels of a document are not features.

score(x) = sigmoid(b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]):
the sum-of-squares identity gives all pairwise interactions in time
linear in the non-zero features.

Fitting uses a sample of labelled rows whose size is a parameter (the
rows with the smallest id hashes); the sample alone reaches the driver.
Scoring reads every whole text on the executors.

Defined results: null and empty texts have no words and get the score of
their (all-zero) statistics and their metadata; an ``n_chars`` that is
missing, null or negative counts as not known; texts of any length are scored whole;
repeated rows get equal scores; an empty table gives an empty result;
labels that are null, or whose id is null, are not learned from; without
any usable label every score is 0.5.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytetext import U, Slices, Words, chunks, mix, text_buffer
from tessera.llm.common import pick
from tessera.session import ship_package

BUCKETS, FACTORS = 1 << 15, 8


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER, DIGIT = byte_class(bytes(range(65, 91))), byte_class(b"0123456789")
SYMBOL, MARK = byte_class(b"#*$%&|<>{}[]\\^~=_@"), byte_class(b"!?")
STOP, NEWLINE = byte_class(b".,;:"), byte_class(b"\n")
LETTER = byte_class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
STATS, META = 18, 2


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(data: np.ndarray, offsets: np.ndarray, w: Words, words: np.ndarray, entries: tuple) -> np.ndarray:
    """Structure and size of each text: one row of STATS numbers."""
    n = len(offsets) - 1

    def count(flags: np.ndarray, first: np.ndarray = offsets) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(flags, dtype=np.float64)])
        return sums[first[1:]] - sums[first[:-1]]

    size, n_words = np.diff(offsets).astype(float), np.diff(w.first).astype(float)
    doc, _, times = entries
    lines = Words(data, offsets, NEWLINE)
    n_lines = np.bincount(lines.doc, minlength=n).astype(float)
    line_ids = mix(Slices.hash(w.slices(), lines.start, lines.end) ^ lines.doc.astype(U))
    once = np.unique(line_ids, return_index=True)[1]
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    length = (w.end - w.start).astype(float)
    plain = letters[w.end] == letters[w.start]
    twice = np.zeros(len(words), bool)
    twice[1:] = (words[1:] == words[:-1]) & (w.doc[1:] == w.doc[:-1])
    most = np.zeros(n)
    np.maximum.at(most, doc, times)
    last = data[np.maximum(lines.end - 1, 0)] if len(data) else np.zeros(0, np.uint8)
    columns = [
        np.log1p(n_words) / 5, np.log1p(size) / 7, share(count(length, w.first), n_words) / 8,
        share(count(UPPER[data]), size) * 8, share(count(DIGIT[data]), size) * 8, share(count(SYMBOL[data]), size) * 8,
        share(count(MARK[data]), size) * 8, share(count(STOP[data]), size) * 8,
        share(count(~LETTER[data]), size) * 3, share(np.bincount(doc, minlength=n), n_words),
        share(most, n_words) * 3, share(count(twice, w.first), n_words) * 4,
        share(n_lines - np.bincount(lines.doc[once], minlength=n), n_lines) * 3,
        np.log1p(n_lines) / 3, np.log1p(share(n_words, n_lines)) / 5, share(count(plain, w.first), n_words) * 4,
        share(count(length >= 20, w.first), n_words) * 4,
        share(np.bincount(lines.doc, weights=STOP[last] | MARK[last], minlength=n), n_lines),
    ]
    return np.stack(columns, 1)


def n_chars_of(df: DataFrame) -> Column:
    """The metadata column as a double, null where the frame has none."""
    return (F.col("n_chars").try_cast("double") if "n_chars" in df.columns else F.lit(None).cast("double")).alias("n_chars_")


def metadata(n_chars: np.ndarray) -> np.ndarray:
    """Size and whether it is known: one row of META numbers."""
    known = np.isfinite(n_chars) & (n_chars >= 0)
    return np.stack([np.log1p(np.where(known, n_chars, 0)) / 7, known], 1)


def features(column: pa.Array, n_chars: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(text, feature, value) of every non-zero feature, by text; and the
    number of texts.  Words are log-counted with unit length per text."""
    data, offsets = text_buffer(column)
    w = Words(data, offsets)
    n = len(offsets) - 1
    words = w.hashes()
    key = w.doc.astype(np.int64) * buckets + (words % U(buckets)).astype(np.int64)
    key, times = np.unique(key, return_counts=True)
    doc, bucket = key // buckets, key % buckets
    value = np.log1p(times)
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=n))
    value = value / np.maximum(norm[doc], 1e-12)
    stats = statistics(data, offsets, w, words, (doc, bucket, times))
    stats = np.concatenate([stats, metadata(n_chars)], 1)
    doc = np.concatenate([doc, np.repeat(np.arange(n), STATS + META)])
    feature = np.concatenate([bucket, np.tile(np.arange(buckets, buckets + STATS + META), n)])
    value = np.concatenate([value, stats.ravel()])
    order = np.argsort(doc, kind="stable")
    return doc[order], feature[order], value[order], n


@dataclasses.dataclass
class Machine:
    """bias, linear weights (features) and factors (features x FACTORS)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = self.bias + np.bincount(doc, weights=self.linear[feature] * value, minlength=n)
        sums = np.zeros((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            part = self.factors[feature, f] * value
            sums[:, f] = np.bincount(doc, weights=part, minlength=n)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(doc, weights=part * part, minlength=n))
        return out, sums

    def scores(self, column: pa.Array, n_chars: np.ndarray) -> np.ndarray:
        raw, _ = self.raw(*features(column, n_chars, len(self.linear) - STATS - META))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit_features(doc, feature, value, labels: np.ndarray, size: int, epochs: int, seed: int, l2: float = 1e-5) -> Machine:
    """Adagrad on the logistic loss, in mini-batches of whole texts."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)))
    if not len(labels):
        m.factors[:] = 0
        return m
    rate = np.clip(labels.mean(), 0.02, 0.98)
    m.bias = float(np.log(rate / (1 - rate)))
    grad2, fgrad2 = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2)
    first = np.searchsorted(doc, np.arange(len(labels) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), 128):
            rows = order[lo:lo + 128]
            span = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows])
            d = np.repeat(np.arange(len(rows)), first[rows + 1] - first[rows])
            f, x = feature[span], value[span]
            raw, sums = m.raw(d, f, x, len(rows))
            slope = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[rows]
            used, at = np.unique(f, return_inverse=True)
            pull = slope[d] * x
            g = np.bincount(at, weights=pull) / len(rows) + l2 * m.linear[used]
            grad2[used] += g * g
            m.linear[used] -= 0.2 * g / np.sqrt(grad2[used])
            for k in range(FACTORS):
                g = np.bincount(at, weights=pull * (sums[d, k] - m.factors[f, k] * x)) / len(rows) + l2 * m.factors[used, k]
                fgrad2[used, k] += g * g
                m.factors[used, k] -= 0.05 * g / np.sqrt(fgrad2[used, k])
            m.bias -= 0.02 * float(slope.mean())
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, most: int) -> DataFrame:
    """(doc_id, text, label, n_chars_) of at most ``most`` labelled documents, the
    ones with the smallest id hashes.  The sample of ids is broadcast: its
    bound is ``most``.  Of rows that repeat an id the one with the smallest
    text is taken (null last), of an id's labels the largest."""
    chosen = (pick(labels, doc_id="doc_id", label=label).where("doc_id is not null and label is not null")
              .where(usable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = docs.select("doc_id", "text", n_chars_of(docs)).join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.col("text").isNull().alias("none"), "text", "n_chars_")).alias("one")
    return rows.groupBy("doc_id", "label").agg(one).select("doc_id", "one.text", "label", "one.n_chars_")


def fit(sample: DataFrame, epochs: int = 12, seed: int = 7, buckets: int = BUCKETS) -> Machine:
    """Fit on a bounded sample (doc_id, text, label, n_chars_)."""
    ship_package(sample.sparkSession)

    def run(batches):
        for batch in chunks(batches, "text"):
            doc, feature, value, n = features(batch.column(1), batch.column(3).to_numpy(zero_copy_only=False), buckets)
            first = np.searchsorted(doc, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(feature, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(value, pa.float32()))],
                ["doc_id", "label", "feature", "value"])

    got = (sample.select("doc_id", "text", "label", "n_chars_")
           .mapInArrow(run, "doc_id long, label int, feature array<int>, value array<float>")
           .toArrow().sort_by("doc_id").combine_chunks())
    flat = got["feature"].combine_chunks().flatten() if got.num_rows else pa.array([], pa.int32())
    values = got["value"].combine_chunks().flatten() if got.num_rows else pa.array([], pa.float32())
    lengths = np.array([len(x) for x in got["feature"]], np.int64)
    doc = np.repeat(np.arange(got.num_rows), lengths)
    return fit_features(doc, flat.to_numpy(), values.to_numpy().astype(float), got["label"].to_numpy().astype(float),
                        buckets + STATS + META, epochs, seed)


def score(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the score of each whole text."""
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(machine)
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text_"), n_chars_of(docs))

    def run(batches):
        for batch in chunks(batches, "text_"):
            scores = model.value.scores(batch.columns[-2], batch.columns[-1].to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(scores)], [*batch.schema.names[:-2], "score_"])

    schema = source.drop("text_", "n_chars_").withColumn("score_", F.lit(0.0)).schema
    return source.mapInArrow(run, schema).toDF(*keep, out)
