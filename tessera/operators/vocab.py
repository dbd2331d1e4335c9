"""Per-row vocabulary lookup: token arrays to id arrays
without an explode, a join or a shuffle, so it runs on a stream too.

The vocabulary travels as one table: token hashes in ascending order, with
the ids and the tokens themselves in that order.  A batch looks up its
distinct tokens only: a binary search for the hash, then a comparison of
the token, so no two tokens are ever taken for each other.

The table is broadcast only if its size, counted before anything is
fetched, is under a bound.  Of larger vocabularies a batch looks up the
frequent tokens this way and joins the rare ones (``sequences.lookup_ids``,
by ``streaming.rowwise.run_batches`` on a stream).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package

#: Bytes that a broadcast vocabulary may take.
PACKED_BYTES = 128 << 20
#: The same where rare tokens can be joined instead: every Python worker of
#: an executor holds its own copy.
LOOKUP_BYTES = 24 << 20
#: Bytes of a token that may be broadcast as a frequent one.
TOKEN_BYTES = 64
#: Tokens looked up at once.
SLICE_TOKENS = 1 << 18


class PackedVocab:
    """Tokens in the order of their hashes."""

    def __init__(self, tokens: pa.Array, ids: np.ndarray):
        hashes = self.hash(tokens)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.ids = hashes[order], ids.astype(np.int32)[order]
        self.tokens = tokens.cast(pa.large_string()).take(pa.array(order))
        same = np.append(self.hashes[1:] == self.hashes[:-1], False)
        ends = np.flatnonzero(~same)
        #: tokens that share a hash at most (1, but for collisions)
        self.widest = int(np.diff(ends, prepend=-1).max()) if len(ends) else 0

    @staticmethod
    def hash(tokens: pa.Array) -> np.ndarray:
        return pd.util.hash_array(tokens.to_numpy(zero_copy_only=False).astype(object), categorize=False)

    def look_up(self, tokens: pa.Array, unknown: int) -> np.ndarray:
        """The id of every token, ``unknown`` where there is none."""
        out = np.full(len(tokens), unknown, np.int32)
        if not len(tokens) or not len(self.ids):
            return out
        hashes = self.hash(tokens)
        at = np.searchsorted(self.hashes, hashes)
        for step in range(self.widest):
            place = np.minimum(at + step, len(self.ids) - 1)
            maybe = np.flatnonzero(self.hashes[place] == hashes)
            equal = pc.equal(self.tokens.take(pa.array(place[maybe])), tokens.take(pa.array(maybe)).cast(pa.large_string()))
            hit = maybe[equal.to_numpy(zero_copy_only=False).astype(bool)]
            out[hit] = self.ids[place[hit]]
        return out


def pack(vocab: DataFrame, most_bytes: int = PACKED_BYTES):
    """The vocabulary ``(token, id)`` as a broadcast, or None where it would
    take more than ``most_bytes``."""
    known = vocab.where(F.col("token").isNotNull()).select("token", F.col("id").cast("int").alias("id"))
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()
    if 20 * n + chars > most_bytes:
        return None
    table = known.toArrow().combine_chunks()
    tokens, ids = (table.column(i).combine_chunks() if n else pa.array([], t) for i, t in ((0, pa.string()), (1, pa.int32())))
    return vocab.sparkSession.sparkContext.broadcast(PackedVocab(tokens, np.asarray(ids)))


def frequent(most_bytes: int) -> Column:
    """Of a vocabulary ``(token, id)`` whose ids ascend from the most
    frequent token: the tokens that take ``most_bytes`` at most."""
    most = most_bytes // (20 + TOKEN_BYTES)
    return F.coalesce(F.col("id").between(0, most - 1) & (F.octet_length("token") <= TOKEN_BYTES), F.lit(False))


def slices(lists: pa.Array):
    """The rows in runs of ``SLICE_TOKENS`` tokens at most (or one row)."""
    ends, at = np.cumsum(sizes(lists)), 0
    while at < len(lists):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_TOKENS, "right"))
        yield lists.slice(at, max(1, to - at))
        at = max(at + 1, to)


def sizes(lists: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0))


def regrouped(size: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), values)


def ids_of(tokens: Column, packed, unknown: int = 0) -> Column:
    """T3 as a column expression: the ids of a token array (an empty array
    for NULL; a NULL token is unknown)."""
    def ids(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().dictionary_encode()
        ids = np.append(packed.value.look_up(flat.dictionary, unknown), np.int32(unknown))
        place = np.asarray(pc.fill_null(flat.indices, len(ids) - 1))
        return regrouped(sizes(lists), pa.array(ids[place], pa.int32()))

    @F.arrow_udf("array<int>")
    def look(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *map(ids, slices(lists))])

    return look(tokens)


def coded(tokens: Column, packed, unknown: int = 0) -> Column:
    """``ids_of`` where ``packed`` holds some tokens only, with ids from 0:
    ``rare`` has a row's other tokens once each, and in ``ids`` -1 stands for
    the first of them, -2 for the second and so on."""
    def code(lists: pa.Array) -> pa.Array:
        flat, size = lists.flatten().dictionary_encode(), sizes(lists)
        names = max(1, len(flat.dictionary))
        known = np.append(packed.value.look_up(flat.dictionary, -1), np.int32(unknown))
        place = np.asarray(pc.fill_null(flat.indices, len(known) - 1)).astype(np.int64)
        ids = known[place]
        rare = np.flatnonzero(ids < 0)
        once, which = np.unique(np.repeat(np.arange(len(lists)), size)[rare] * names + place[rare], return_inverse=True)
        row = once // names
        first = np.searchsorted(row, np.arange(len(lists) + 1))
        ids[rare] = first[row][which] - which - 1
        others = flat.dictionary.take(pa.array(once % names))
        return pa.StructArray.from_arrays([regrouped(size, pa.array(ids, pa.int32())), regrouped(np.diff(first), others.cast(pa.string()))],
                                          names=["ids", "rare"])

    kind = pa.struct([("ids", pa.list_(pa.int32())), ("rare", pa.list_(pa.string()))])

    @F.arrow_udf("struct<ids:array<int>,rare:array<string>>")
    def look(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], kind), *(code(x).cast(kind) for x in slices(lists))])

    return look(tokens)


def need_packed(vocab: DataFrame, most_bytes: int = PACKED_BYTES):
    """``pack`` for callers that have no other way."""
    packed = pack(vocab, most_bytes)
    if packed is None:
        raise ValueError(f"the vocabulary takes more than {most_bytes} bytes; encode the stream by run_batches and lookup_ids")
    ship_package(vocab.sparkSession)
    return packed
