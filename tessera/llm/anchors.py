"""Substring deduplication with difference-cover anchors.

A difference cover D modulo v has, for any two places i and j, an offset
t < v with i + t and j + t both in D (mod v).  So two equal windows of
``window`` words share an equal anchor of window - v + 1 words at places
that both texts sample, and only every v / |D|-th anchor is hashed.

1. Every text sends its sampled anchors; an anchor hash seen in two
   documents marks its places.
2. Only windows around marked anchors are extended to their full length
   and compared, by 96-bit hashes: a window goes if a document with a
   smaller id holds it too.
3. Words covered by such windows are removed.

Texts are dealt by id once and that exchange serves all three passes.
Anchors and windows travel packed, many to a row, and are settled in two
steps: within a block of texts first, which leaves at most two entries
of a hash for each block, then across blocks in hash buckets.  A passage
that a third of all documents share is thus a few entries per block.

Defined results: null and empty texts have no words; texts under
``window`` words lose nothing; windows never span two rows; rows with
the same id do not remove from each other; rows with a null id neither
lose words nor make others lose any; an empty table gives an empty
result; other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytetext import BASE_A, BASE_B, U, Slices, Words, chunks, text_buffer
from tessera.llm.common import shuffle_partitions
from tessera.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from tessera.session import ship_package

#: A perfect difference set: every difference modulo 31 occurs once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
BLOCK = 300_000  # anchors or windows that are settled together
ENTRIES = "key int, docs binary, marks binary, counts binary, places binary, high binary, low binary"
FOUND = "part int, docs binary, marks binary, counts binary, places binary"
PER_DOC = "id long, marks binary, counts binary, places binary"


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the (sorted) keys begins, and the end."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(new))


class Entries:
    """doc, mark (tells rows of one id apart), place and 96-bit hash."""

    def __init__(self, doc, mark, place, high, low):
        self.columns = [doc, mark, place, high, low]
        self.doc, self.mark, self.place, self.high, self.low = self.columns

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, rows: np.ndarray) -> Entries:
        return Entries(*[c[rows] for c in self.columns])

    @staticmethod
    def join(parts: list[Entries]) -> Entries:
        return Entries(*[np.concatenate(c) for c in zip(*[p.columns for p in parts])])

    def settle(self, exact: bool) -> tuple[Entries, np.ndarray, np.ndarray]:
        """Sorted entries; which are found; which stand for their hash.

        exact: found are those with a larger id than the smallest of their
        hash, and the smallest stands for it.  Otherwise all entries of a
        hash with two documents are found, and two of them stand for it."""
        e = self.take(np.lexsort((self.place, self.doc, self.low, self.high)))
        if not len(e):
            return e, np.zeros(0, bool), np.zeros(0, bool)
        at = groups(e.high, e.low)
        size = np.diff(at)
        smallest, largest = e.doc[at[:-1]], e.doc[at[1:] - 1]
        if exact:
            found = e.doc > np.repeat(smallest, size)
            return e, found, ~found
        found = np.repeat(smallest != largest, size)
        stands = ~found
        stands[at[:-1]] = stands[at[1:] - 1] = True
        return e, found, stands

    def rows(self, key: np.ndarray, hashes: bool) -> Iterator[tuple]:
        """One packed row for each key."""
        order = np.lexsort((self.place, self.mark, self.doc, key))
        e, key = self.take(order), key[order]
        ends = groups(key)
        for lo, hi in zip(ends[:-1], ends[1:]):
            per = groups(e.doc[lo:hi], e.mark[lo:hi])
            first = lo + per[:-1]
            row = (int(key[lo]), pack_sorted(e.doc[first]), pack(e.mark[first]), pack(np.diff(per)), pack(e.place[lo:hi]))
            yield (*row, e.high[lo:hi].tobytes(), e.low[lo:hi].tobytes()) if hashes else row


def unrow(docs, marks, counts, places, high=None, low=None) -> Entries:
    n, place = unpack(counts), unpack(places)
    none = np.zeros(len(place), U)
    return Entries(np.repeat(unpack_sorted(docs), n), np.repeat(unpack(marks), n), place,
                   none if high is None else np.frombuffer(high, U), none if low is None else np.frombuffer(low, np.uint32))


def table(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split(" ")[0] for f in schema.split(", ")])


def part_of(doc: np.ndarray, buckets: int) -> np.ndarray:
    """Found places are gathered by document in half as many parts as
    there are hash buckets: they are few beside what is compared."""
    return ((doc.astype(U) * U(BASE_A)) >> U(33)).astype(np.int64) % max(8, buckets // 2)


def flush(parts: list[Entries], exact: bool, buckets: int) -> pd.DataFrame:
    """Settle a block: what is found already, by document part (keys from
    ``buckets`` on), and what must meet other blocks, by hash bucket."""
    e, found, stands = Entries.join(parts).settle(exact)
    known, sent = e.take(found), e.take(stands)
    empty = np.zeros(len(known), U)
    known.high, known.low = known.columns[3:] = [empty, empty.astype(np.uint32)]
    rows = [*known.rows(buckets + part_of(known.doc, buckets), False),
            *sent.rows(((sent.high >> U(32)) % U(buckets)).astype(np.int64), True)]
    return table([r if len(r) == 7 else (*r, None, None) for r in rows], ENTRIES)


def settled(blocks: DataFrame, exact: bool, buckets: int) -> DataFrame:
    """(id, marks, counts, places): the found places of each document."""
    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["key"].iloc[0] >= buckets:
            out = pdf.assign(key=pdf["key"] - buckets).rename(columns={"key": "part"})
            return out[["part", "docs", "marks", "counts", "places"]]
        columns = [pdf[c] for c in ("docs", "marks", "counts", "places", "high", "low")]
        e, found, _ = Entries.join([unrow(*r) for r in zip(*columns)]).settle(exact)
        e = e.take(found)
        return table(list(e.rows(part_of(e.doc, buckets), False)), FOUND)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        e = Entries.join([unrow(*r) for r in zip(pdf["docs"], pdf["marks"], pdf["counts"], pdf["places"])])
        e = e.take(np.lexsort((e.place, e.mark, e.doc)))
        e = e.take(groups(e.doc, e.mark, e.place)[:-1])
        ends, rows = groups(e.doc), []
        for lo, hi in zip(ends[:-1], ends[1:]):
            per = groups(e.mark[lo:hi])
            rows.append((int(e.doc[lo]), pack(e.mark[lo:hi][per[:-1]]), pack(np.diff(per)), pack(e.place[lo:hi])))
        return table(rows, PER_DOC)

    return (blocks.groupBy("key").applyInPandas(bucket, FOUND)
            .groupBy("part").applyInPandas(merge, PER_DOC))


def marked(words: Words, column: int, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the places found for the rows of a batch: those
    with the row's own mark."""
    texts, places = [], []
    blobs = [batch.column(column + i).to_pylist() for i in range(3)]
    own = batch.column(2).to_pylist()
    for i, (marks, counts, place) in enumerate(zip(*blobs)):
        if marks is not None:
            at = unpack(place)[np.repeat(unpack(marks) == own[i], unpack(counts))]
            texts.append(np.full(len(at), i))
            places.append(at)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(texts + none), np.concatenate(places + none)


def span_union(words: Words, text: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Words in the union of [before, after) of their text, clipped to it."""
    n = len(words)
    low, high = words.first[text], words.first[text + 1]
    a, b = np.clip(low + before, low, high), np.clip(low + after, low, high)
    return np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1))[:n] > 0


def kept_text(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    doc, start, end = words.doc[keep], words.start[keep], words.end[keep]
    size = end - start + 1
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    size -= last
    out = np.cumsum(size) - size
    index = np.repeat(start - out, size) + np.arange(size.sum())
    data = words.data[np.minimum(index, max(len(words.data) - 1, 0))] if len(index) else np.zeros(0, np.uint8)
    data = data.copy()
    data[(out + size - 1)[~last]] = 32
    n = len(words.offsets) - 1
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=n))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def substring_dedup(docs: DataFrame, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
                    window: int = 50, verbatim: bool = False) -> DataFrame:
    """The columns ``keep`` (all by default) with n_words, n_removed and
    kept (the words that stay, joined by one space) of every row.
    ``verbatim``: where nothing goes, kept is the text as it was (null too)."""
    if window < PERIOD:
        raise ValueError(f"windows of under {PERIOD} words need a shorter period")
    spark = docs.sparkSession
    ship_package(spark)
    keep = docs.columns if keep is None else keep
    buckets = shuffle_partitions(spark)
    anchor = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    id_, text_ = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    # a name of its own: an alias that Spark drops as redundant in one of the
    # three uses would make their exchanges differ
    rows = docs.select(id_.alias("id"), text_.alias("text__"), F.coalesce(F.xxhash64(text_).bitwiseAND(0xFFFFFFFF), F.lit(0)).alias("mark"),
                        F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]).alias("row"))
    # one filter for all three passes, else the joins' own one keeps Spark from using the exchange again
    dealt = rows.where("id is not null").repartition("id")

    def anchors(batches):
        parts, n = [], 0
        for batch in chunks(batches, "text__"):
            w = Words(*text_buffer(batch.column(1)))
            size, place = np.diff(w.first), np.arange(len(w)) - w.first[w.doc]
            at = np.flatnonzero(cover[place % PERIOD] & (place + anchor <= size[w.doc]) & (size >= window)[w.doc])
            high = Slices(w.hashes(), BASE_B).hash(at, at + anchor)
            ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            parts.append(Entries(ids[w.doc[at]], marks[w.doc[at]], place[at], high, np.zeros(len(at), np.uint32)))
            n += len(at)
            if n >= BLOCK:
                yield from pa.Table.from_pandas(flush(parts, False, buckets), entries, preserve_index=False).to_batches()
                parts, n = [], 0
        if n:
            yield from pa.Table.from_pandas(flush(parts, False, buckets), entries, preserve_index=False).to_batches()

    def windows(batches):
        parts, n = [], 0
        for batch in chunks(batches, "text__"):
            w = Words(*text_buffer(batch.column(1)))
            doc, p = marked(w, 3, batch)
            size, place = np.diff(w.first), np.arange(len(w)) - w.first[w.doc]
            near = span_union(w, doc, p - PERIOD + 1, p + 1)
            at = np.flatnonzero(near & (place + window <= size[w.doc]))
            high = Slices(w.hashes(), BASE_B).hash(at, at + window)
            low = (Slices(w.hashes(BASE_B), BASE_A).hash(at, at + window) >> U(32)).astype(np.uint32)
            ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            parts.append(Entries(ids[w.doc[at]], marks[w.doc[at]], place[at], high, low))
            n += len(at)
            if n >= BLOCK:
                yield from pa.Table.from_pandas(flush(parts, True, buckets), entries, preserve_index=False).to_batches()
                parts, n = [], 0
        if n:
            yield from pa.Table.from_pandas(flush(parts, True, buckets), entries, preserve_index=False).to_batches()

    def remove(batches):
        for batch in chunks(batches, "text__"):
            w = Words(*text_buffer(batch.column(1)))
            doc, p = marked(w, 3, batch)
            gone = span_union(w, doc, p, p + window)
            removed = np.bincount(w.doc[gone], minlength=len(w.first) - 1).astype(np.int64)
            kept = kept_text(w, ~gone)
            if verbatim:
                kept = pc.if_else(pa.array(removed > 0), kept, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(6), pa.array(np.diff(w.first).astype(np.int64)), pa.array(removed), kept],
                ["row", "n_words", "n_removed", "kept"])

    entries = pa.schema([("key", pa.int32()), *[(c, pa.binary()) for c in ("docs", "marks", "counts", "places", "high", "low")]])
    shared = settled(dealt.mapInArrow(anchors, ENTRIES), False, buckets)
    near = dealt.join(shared.toDF("id_", "m", "c", "p"), F.col("id") == F.col("id_")).select("id", "text__", "mark", "m", "c", "p", "row")
    later = settled(near.mapInArrow(windows, ENTRIES), True, buckets)
    every = dealt.join(later.toDF("id_", "m", "c", "p"), F.col("id") == F.col("id_"), "left").select("id", "text__", "mark", "m", "c", "p", "row")
    nameless = rows.where("id is null")
    every = every.union(nameless.select("id", "text__", "mark", *[F.lit(None).cast("binary")] * 3, "row"))
    schema = every.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept")).schema
    out = every.mapInArrow(remove, schema)
    return out.select(*[F.col(f"row.k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_removed", "kept")
