"""Set-similarity join on word shingles with adaptive multi-match prefixes.

Two sets of at least ``percent`` Jaccard share so much that, in any one
order of all shingles, the first n - ceil(percent * n / 100) + m of each
have m in common.  A longer prefix costs more postings but demands more
matches of a candidate.  So every document weighs, from estimated
frequencies of its own prefix, what m = 1, 2, ... would cost, and takes
the cheapest; a pair must share the smaller m of its two documents.

1. Frequencies: shingles are counted in a table of cells, of one byte each
   where it is kept (a cell for every 200 bytes of text, about 30 shingles;
   4 million at least, 32 million at most).  Rare shingles come first in
   the order, ties by hash, so that frequent passages hardly enter prefixes.
2. Every text is hashed again: its set's hash (equal sets are one node),
   its m, and its prefix.
3. A shingle that up to ``FEW`` prefixes hold gives its pairs, which are
   counted: those with fitting sizes and enough matches (taking every
   other shingle of the pair's prefixes as one more) are candidates.  A
   shingle that more prefixes hold gives one star, a row a posting.  The
   components of both are groups of sets.
4. A group's sets are cut into blocks by size and hash, bounded in sets
   and shingles; a cell is a pair of blocks whose sizes can reach the
   threshold.  A cell returns its links as stars, at most one for each of
   its sets, so no pair of a group leaves a task.  This is done twice: with
   the prefixes alone, which gives smaller groups of the sets that have
   enough matches with another; then with the whole sets of those groups,
   for the pairs with enough matches.
5. Components of the verified links.

A prefix token is dealt out once, without its set's sizes, and texts are
not dealt out at all: a bit table tells which of them to read for whole
sets.

The work inside one group grows with the square of its different sets of
like size; equal sets are one node.

Shingles are compared by 64-bit hashes.

Defined results: null and empty texts have the empty set and link with
nothing (component: the own id); texts under the shingle length are one
shingle; a component is named by its smallest non-null id (null if it
has none); rows that repeat an id are told apart by their text; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytetext import BASE_B, U, Slices, Words, chunks, lists, mix, text_buffer
from tessera.llm.collocations import bit_table
from tessera.llm.common import pick, written
from tessera.llm.components import components
from tessera.llm.packing import pack, unpack
from tessera.llm.simhash import join_labels
from tessera.plans.ranking import cluster
from tessera.session import ship_package

#: Cells of the frequency table: at least, at most, and bytes of text for one.
COUNTERS, MOST_COUNTERS, TEXT_BYTES = 1 << 22, 1 << 25, 200
#: Parts of the table that are added up.
PARTS = 1024
#: Bits of the table of texts whose whole sets are wanted.
BITS = 1 << 26
#: Postings of a shingle whose pairs are counted before they are candidates.
FEW = 16
#: What the verification of a candidate costs, in postings read.
VERIFY = 8


class Shingles:
    """Distinct shingle hashes, text by text: text i holds
    hashes[first[i]:first[i + 1]], ascending."""

    def __init__(self, column: pa.Array, shingle: int):
        data, offsets = text_buffer(column)
        data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
        w = Words(data, offsets)
        size = np.diff(w.first)
        place = np.arange(len(w)) - w.first[w.doc]
        at = np.flatnonzero((place + shingle <= size[w.doc]) | (place == 0))
        doc = w.doc[at]
        hashes = Slices(w.hashes(), BASE_B).hash(at, np.minimum(at + shingle, w.first[doc + 1]))
        order = np.lexsort((hashes, doc))
        doc, hashes = doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        self.doc, self.hashes = doc[new], hashes[new]
        self.n = np.bincount(self.doc, minlength=len(size)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def node(self) -> np.ndarray:
        """A hash of each set (0 for the empty one)."""
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(self.hashes), dtype=U)])
        return mix(total[self.first[1:]] - total[self.first[:-1]] + self.n.astype(U)).view(np.int64)


def cell_of(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (hashes % U(counters)).astype(np.int64)


def table_size(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_COUNTERS, max(COUNTERS, 1 << (size // TEXT_BYTES).bit_length()))


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: exact below 128, then eight to a doubling."""
    high = 128 + 8 * np.log2(np.maximum(counts, 128) / 128)
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def decoded() -> np.ndarray:
    code = np.arange(256.0)
    return np.where(code < 128, code, 128 * 2 ** ((code - 128) / 8))


def frequencies(docs: DataFrame, shingle: int, counters: int) -> np.ndarray:
    """In how many rows each cell's shingles occur, over all rows (coded)."""
    width = -(-counters // PARTS)

    def count(batches):
        total = np.zeros(counters, np.uint32)
        for batch in chunks(batches, "text"):
            np.add.at(total, cell_of(Shingles(batch.column(0), shingle).hashes, counters), np.uint32(1))
        for b in range(PARTS):
            cells = total[b * width:(b + 1) * width]
            if cells.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "cells": pa.array([pack(cells)], pa.binary())})

    def add(last):
        def run(pdf):
            return pdf.iloc[:1].assign(cells=[pack(last(reduce(np.add, map(unpack, pdf["cells"]))))])
        return run

    parts = docs.select("text").mapInArrow(count, "block int, cells binary")
    parts = parts.withColumn("some", F.floor(F.spark_partition_id() / 256).cast("int"))
    sums = (parts.groupBy("block", "some").applyInPandas(add(lambda cells: cells), "block int, cells binary, some int")
            .groupBy("block").applyInPandas(add(coded), "block int, cells binary, some int"))
    out = np.zeros(counters, np.uint8)
    for row in sums.select("block", "cells").collect():  # a byte a cell at most
        cells = unpack(row["cells"])
        out[row["block"] * width:row["block"] * width + len(cells)] = cells
    return out


def choose(n: np.ndarray, first: np.ndarray, weight: np.ndarray, percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of matches m that is cheapest for each set, and the length
    of its prefix.  ``weight`` is the estimated number of partners of each
    shingle, in the global order: an m-match prefix reads their sum, and at
    most a sum / m of partners can have m matches."""
    need = -(-percent * n // 100)
    total = np.concatenate([[0.0], np.cumsum(weight)])
    best, matches = np.full(len(n), np.inf), np.ones(len(n), np.int64)
    for m in range(1, most + 1):
        length = np.minimum(n, n - need + m)
        cost = (total[first[:-1] + length] - total[first[:-1]]) * (1 + VERIFY / m)
        cheaper = (cost < best) & (m <= np.maximum(need, 1))
        best, matches = np.where(cheaper, cost, best), np.where(cheaper, m, matches)
    return matches, np.where(n > 0, np.minimum(n, n - need + matches), 0)


class Order:
    """The global order of shingles, and what it makes of texts."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int, counters: int, most: int):
        table = frequencies(docs, shingle, counters)
        self.value = decoded()
        self.mean = float(np.bincount(table, minlength=256) @ self.value / max(1, len(table)))  # what a cell holds anyway
        self.table = docs.sparkSession.sparkContext.broadcast(table)
        self.shingle, self.percent, self.counters, self.most = shingle, percent, counters, most

    def of(self, texts: pa.Array) -> tuple[Shingles, np.ndarray, np.ndarray, np.ndarray]:
        """The sets, their tokens in the global order, m and prefix length."""
        s = Shingles(texts, self.shingle)
        seen = self.table.value[cell_of(s.hashes, self.counters)]
        order = np.lexsort((seen, s.doc))  # stable: ties stay ordered by hash
        weight = 0.01 + np.maximum(self.value[seen[order]] - 1 - self.mean, 0)
        m, length = choose(s.n, s.first, weight, self.percent, self.most)
        return s, s.hashes[order].view(np.int64), m, length


def prefixes(docs: DataFrame, order: Order) -> DataFrame:
    """(doc_id, mark, node, n, m, tokens) of every row; tokens: the prefix."""
    def run(batches):
        for batch in chunks(batches, "text"):
            s, tokens, m, length = order.of(batch.column(2))
            inside = (np.arange(len(tokens)) - s.first[s.doc]) < length[s.doc]
            prefix = lists(tokens[inside], np.concatenate([[0], np.cumsum(length)]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s.node()), pa.array(s.n), pa.array(m.astype(np.int32)), prefix],
                                             ["doc_id", "mark", "node", "n", "m", "tokens"])

    return docs.select("doc_id", "mark", "text").mapInArrow(run, "doc_id long, mark long, node long, n long, m int, tokens array<long>")


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """How many tokens each row of a shares with each row of b; a and b:
    (tokens, row of each).  Frequent tokens are columns of a matrix
    product, the others are counted pair by pair."""
    (ta, ra), (tb, rb) = a, b
    out = np.zeros(shape, np.float32)
    ia, ib = np.argsort(ta, kind="stable"), np.argsort(tb, kind="stable")
    ta, ra, tb, rb = ta[ia], ra[ia], tb[ib], rb[ib]
    token, la, ca = np.unique(ta, return_index=True, return_counts=True)
    lb, hb = np.searchsorted(tb, token), np.searchsorted(tb, token, "right")
    both = hb > lb
    la, ca, lb, cb = la[both], ca[both], lb[both], (hb - lb)[both]
    dense = ca * cb > max(64, shape[0] * shape[1] // 64)
    wide = np.flatnonzero(dense)
    for lo in range(0, len(wide), 512):
        some = wide[lo:lo + 512]
        x, y = np.zeros((shape[0], len(some)), np.float32), np.zeros((shape[1], len(some)), np.float32)
        for k, t in enumerate(some):
            x[ra[la[t]:la[t] + ca[t]], k] = 1
            y[rb[lb[t]:lb[t] + cb[t]], k] = 1
        out += x @ y.T
    la, ca, lb, cb = la[~dense], ca[~dense], lb[~dense], cb[~dense]
    upto = np.cumsum(ca * cb)
    at = 0
    while at < len(ca):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 20), "right")))
        size = (ca * cb)[at:to]
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat(cb[at:to], size)
        rows, cols = ra[np.repeat(la[at:to], size) + k // width], rb[np.repeat(lb[at:to], size) + k % width]
        np.add.at(out.reshape(-1), rows * shape[1] + cols, np.float32(1))
        at = to
    return out


class Block:
    """Sets of a cell: their nodes, sizes, m, prefix lengths, and tokens (of
    the prefix alone, or of the whole set)."""

    def __init__(self, pdf: pd.DataFrame):
        sets = [np.frombuffer(x, np.int64) if isinstance(x, bytes) else np.asarray(x, np.int64) for x in pdf["tokens"]]
        self.node = pdf["node"].to_numpy(np.int64)
        self.m, self.length = pdf["m"].to_numpy(np.int64), pdf["length"].to_numpy(np.int64)
        self.n = pdf["n"].to_numpy(np.int64)
        held = np.array([len(x) for x in sets], np.int64)
        self.tokens = np.concatenate([*sets, np.zeros(0, np.int64)])
        self.row = np.repeat(np.arange(len(sets)), held)
        self.place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(held) - held, held)

    def part(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.tokens[inside], self.row[inside]


def compare(a: Block, b: Block, same: bool, percent: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, smallest of its local group) of a cell: of pairs that
    reach the threshold, or have enough matches in their prefixes (not whole)."""
    shape = (len(a.n), len(b.n))
    need = -(-percent * (a.n[:, None] + b.n[None, :]) // (100 + percent))  # overlap at the threshold
    matches = overlaps(a.part(a.place < a.length[a.row]), b.part(b.place < b.length[b.row]), shape)
    # matches beyond the shorter prefix's end are at most what is left of that set
    left = np.maximum((a.n - a.length)[:, None], (b.n - b.length)[None, :])
    asked = np.maximum(np.minimum(a.m[:, None], b.m[None, :]), need - left)
    ok = (matches >= asked) & (need <= np.minimum(a.n[:, None], b.n[None, :]))
    if same:
        ok &= np.arange(shape[0])[:, None] < np.arange(shape[1])[None, :]
    none = np.zeros(0, np.int64)
    if not ok.any():
        return none, none
    if whole:
        some_a, some_b = ok.any(1), ok.any(0)
        ok &= overlaps(a.part(some_a[a.row]), b.part(some_b[b.row]), shape) >= need
    i, j = np.nonzero(ok)
    nodes = np.unique(np.concatenate([a.node[i], b.node[j]]))
    label = join_labels(np.arange(len(nodes)), np.searchsorted(nodes, a.node[i]), np.searchsorted(nodes, b.node[j]))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def whole_sets(docs: DataFrame, rows: DataFrame, groups: DataFrame, order: Order) -> DataFrame:
    """(node, n, m, length, tokens, group) of the nodes of ``groups``; tokens:
    the whole set in the global order, packed."""
    # one row stands for each set
    stands = rows.groupBy("node").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
    stands = stands.join(groups, F.col("node") == F.col("node_"), "left_semi")
    key = F.xxhash64("doc_id", "mark")
    bits = bit_table(stands.select("one.*").select(key.alias("h")), BITS)

    def sets(batches):
        for batch in chunks(batches, "text"):
            k = batch.column(0).to_numpy().view(U) % U(BITS)
            wanted = (bits.value[(k >> U(3)).astype(np.int64)] >> (k & U(7)).astype(np.uint8) & 1).astype(bool)
            if not wanted.any():
                continue
            s, tokens, m, length = order.of(batch.column(1).filter(pa.array(wanted)))
            blobs = [tokens[lo:hi].tobytes() for lo, hi in zip(s.first[:-1], s.first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(s.node()), pa.array(s.n), pa.array(m.astype(np.int32)),
                                              pa.array(length), pa.array(blobs, pa.binary())], ["node", "n", "m", "length", "tokens"])

    out = docs.select(key.alias("key"), "text").mapInArrow(sets, "node long, n long, m int, length long, tokens binary")
    # the bits of others, and rows that share id and text, go
    return out.join(groups, F.col("node") == F.col("node_")).drop("node_").dropDuplicates(["node"])


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(node_, group): groups of sets that prefix tokens tie together."""
    # dealt once: the counts and the join read the same exchange
    posts = cluster(rows.where("n > 0").select("node", F.explode("tokens").alias("token")), "token").distinct()
    several = posts.groupBy("token").agg(F.count("*").alias("c"), F.min("node").alias("lo")).where("c > 1").withColumnRenamed("token", "token_")
    posts = written(posts.join(several, F.col("token") == F.col("token_")).drop("token_"), "postings")
    often = posts.where(F.col("c") > FEW)
    stars = often.where("node <> lo").select(F.col("node").alias("u"), F.col("lo").alias("v"))
    wide = often.groupBy("node").agg(F.count("*").alias("wide")).withColumnRenamed("node", "node_")
    facts = rows.where("n > 0").select(F.col("node").alias("of"), "n", "m", F.size("tokens").alias("length")).distinct()
    few = posts.where(F.col("c") <= FEW).join(facts, F.col("node") == F.col("of")).join(wide, F.col("node") == F.col("node_"), "left").select(
        "token", "node", "n", "m", "length", F.coalesce("wide", F.lit(0)).alias("wide"))
    few = written(few, "few")
    a, b = few.toDF("ta", "u", "na", "ma", "la", "wa"), few.toDF("tb", "v", "nb", "mb", "lb", "wb")
    fit = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
    need = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    left = F.greatest(F.col("na") - F.col("la"), F.col("nb") - F.col("lb"))
    pairs = (a.join(b, (F.col("ta") == F.col("tb")) & (F.col("u") < F.col("v")) & fit)
             .groupBy("u", "v", "na", "nb", "ma", "mb", "la", "lb", "wa", "wb").agg(F.count("*").alias("matches"))
             .where(F.col("matches") + F.least("wa", "wb") >= F.greatest(F.least("ma", "mb"), need - left)).select("u", "v"))
    return written(components(stars.union(pairs)).toDF("node_", "group"), "groups")


def met(sets: DataFrame, percent: int, block_sets: int, block_shingles: int, whole: bool) -> DataFrame:
    """(u, v): star links of the cells of each group; sets: (node, n, m,
    length, tokens, group), with whole sets or prefixes as tokens."""
    # sizes whose ratio is within the threshold are in the same class or neighbouring ones
    ratio = float(np.log(100 / percent)) * (1 + 1e-9)
    sets = written(sets.withColumn("class", F.floor(F.log(F.col("n")) / F.lit(ratio))), "sets" if whole else "thin")
    parts = sets.groupBy("group", "class").agg(F.count("*").alias("c"), F.sum("n" if whole else "length").alias("s")).select(
        F.col("group").alias("g"), F.col("class").alias("k"), F.col("c"),
        F.greatest(F.ceil(F.col("c") / block_sets), F.ceil(F.col("s") / block_shingles)).cast("int").alias("parts"))
    parts = written(parts, "parts")
    near = sets
    for step, name in ((-1, "below"), (0, "parts"), (1, "above")):
        p = parts.select(F.col("g").alias(f"g{name}"), (F.col("k") - step).alias(f"k{name}"), F.col("parts").alias(name), F.col("c").alias(f"c{name}"))
        near = near.join(p, (F.col("group") == F.col(f"g{name}")) & (F.col("class") == F.col(f"k{name}")), "left")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    # the blocks that the own one meets: (class, part, class, part) in ascending order
    mine = F.struct(F.col("class").alias("k"), F.col("part").alias("p"))

    def meets(step: int, count: str):
        there = F.transform(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1),
                            lambda p: F.struct((F.col("class") + step).alias("k"), p.cast("int").alias("p")))
        # a single set has nothing to meet in its own class
        some = F.col(count).isNotNull() if step else F.col("cparts") > 1
        return F.when(some, there).otherwise(F.slice(there, 1, 0))

    cells = near.withColumn("part", own).withColumn(
        "other", F.explode(F.concat(meets(-1, "below"), meets(0, "parts"), meets(1, "above"))))
    held = ["node", "n", "m", "length", "tokens"]
    cells = cells.select("group", F.least(mine, "other").alias("x"), F.greatest(mine, "other").alias("y"),
                         (mine == F.least(mine, "other")).alias("first"), *held)
    cells = cells.select("group", F.col("x.k").alias("xk"), F.col("x.p").alias("xp"), F.col("y.k").alias("yk"),
                         F.col("y.p").alias("yp"), "first", *held)

    def cell(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        same = key[1:3] == key[3:5]
        a, b = Block(pdf[pdf["first"]]), Block(pdf if same else pdf[~pdf["first"]])
        u, v = compare(a, b, same, percent, whole)
        return pd.DataFrame({"u": u, "v": v})

    found = cells.groupBy("group", "xk", "xp", "yk", "yp").applyInPandas(cell, "u long, v long")
    return written(found, "links")


def links(docs: DataFrame, rows: DataFrame, order: Order, block_sets: int, block_shingles: int) -> DataFrame:
    """(u, v) between nodes; their components are those of all pairs that
    reach the threshold."""
    groups = candidates(rows, order.percent)
    thin = rows.join(groups, F.col("node") == F.col("node_")).dropDuplicates(["node"]).select(
        "node", "n", "m", F.size("tokens").cast("long").alias("length"), "tokens", "group")
    tied = met(thin, order.percent, block_sets, block_shingles, whole=False)
    groups = written(components(tied).toDF("node_", "group"), "groups")
    return met(whole_sets(docs, rows, groups, order), order.percent, block_sets, block_shingles, whole=True)


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 90,
            counters: int | None = None, most: int = 4, block_sets: int = 2048, block_shingles: int = 1 << 19) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    ship_package(docs.sparkSession)
    docs = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    order = Order(docs, shingle, percent, counters or table_size(docs), most)
    rows = written(prefixes(docs, order), "prefixes")
    roots = components(links(docs, rows, order, block_sets, block_shingles))
    sets = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("id"))
    sets = sets.join(roots.toDF("node_", "root"), F.col("node") == F.col("node_"), "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"))
    sets = written(sets, "grouped")
    least = sets.groupBy("root").agg(F.min("id").alias("component_id")).withColumnRenamed("root", "r")
    named = written(sets.join(least, F.col("root") == F.col("r")).select(F.col("node").alias("node_"), "component_id"), "named")
    return rows.join(named, (F.col("node") == F.col("node_")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
