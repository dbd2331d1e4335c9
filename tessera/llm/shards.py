"""K-d tree sharding of documents by metadata.

The points are documents, their dimensions size (logarithmic), word
length and checksum, their weight the size in bytes.  A node that is to
become several shards is split along its widest dimension (relative to
the whole table's range) at the weighted median, or the quantile by the
numbers of shards on either side, until every leaf is one shard of the
target bytes.

Medians are found by distributed histograms: each pass sums the weights
of at most BINS bins for every node of a level at once and narrows the
bin that holds the median to its smallest and largest value.  No row is
shuffled for that; the driver sees nodes x bins sums and keeps the tree,
which has one split less than there are shards.

All dimensions are functions of the text, so equal texts are one point
and stay in one shard, unless a cut beside the group would miss the
median by more than ``slack`` of a shard: then the group is cut by id.

Defined results: null texts weigh 16 bytes and have checksum 0, as empty
ones do; null ids sort as the smallest; repeated rows are points of their
own; with fewer texts than shards some shards stay empty; an empty table
gives an empty result.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import n_words, written

BINS = 1024
SLOT_BUCKETS = 1024
KEYS = ("by_size", "by_word", "by_sum")


@dataclasses.dataclass
class Node:
    """A region that becomes ``leaves`` shards from ``first`` on; once
    split, rows with (key, id) below the cut are on the left."""

    first: int
    leaves: int
    key: str = ""
    cut: int = 0
    cut_id: int | None = None
    left: Node | None = None
    right: Node | None = None

    def place(self, of) -> Column:
        if self.left is None:
            return of(self)
        on = F.col(self.key) < self.cut
        if self.cut_id is not None:
            on = on | ((F.col(self.key) == self.cut) & (F.col("id_key") < F.lit(self.cut_id).cast("decimal(20,0)")))
        return F.when(on, self.left.place(of)).otherwise(self.right.place(of))


def points(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, size, text_crc32 and a sortable key for each dimension:
    its value above, the other parts of the text's digest below."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), (F.octet_length(t) + 16).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), n_words(t).alias("n"))
    log = F.floor(F.log2("size") * 256).cast("long")
    word = F.least(F.floor(F.col("size") * 16 / (F.col("n") + 1)).cast("long"), F.lit(16383).cast("long"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.coalesce("doc_id", F.lit(-(1 << 63))).cast("decimal(20,0)").alias("id_key"),
        (F.shiftleft(log, 32) + F.col("text_crc32")).alias("by_size"),
        (F.shiftleft(word, 32) + F.col("text_crc32")).alias("by_word"),
        (F.shiftleft("text_crc32", 14) + log).alias("by_sum"))


def lookup(values: dict[int, object], kind: str) -> Column:
    """values[node] for the column ``node``."""
    return F.element_at(F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, v)]), F.col("node")).cast(kind)


def weighted_cuts(rows: DataFrame, value: Column, kind: str, goal: dict[int, int],
                  ends: dict[int, tuple[int, int]], below: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """For each node the value at which the weight passes its goal, the
    weight below that value and the weight at it.

    rows: (node, weight) and what ``value`` reads; ends: the node's range;
    below: the weight below that range."""
    found: dict[int, tuple[int, int, int]] = {}
    ends, below = dict(ends), dict(below)
    while ends:
        width = {k: max(1, -(-(hi - lo + 1) // BINS)) for k, (lo, hi) in ends.items()}
        low, high = lookup({k: str(e[0]) for k, e in ends.items()}, kind), lookup({k: str(e[1]) for k, e in ends.items()}, kind)
        inside = rows.where(F.col("node").isin(list(ends))).withColumn("v", value).where((F.col("v") >= low) & (F.col("v") <= high))
        bin_ = F.call_function("div", F.col("v") - low, lookup({k: str(w) for k, w in width.items()}, kind))
        sums: dict[int, list] = {}
        for r in inside.groupBy("node", bin_.alias("bin")).agg(F.sum("size").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            sums.setdefault(r["node"], []).append((int(r["lo"]), int(r["hi"]), int(r["w"])))
        for node in list(ends):
            bins = sorted(sums[node])
            for lo, hi, w in bins:
                if below[node] + w > goal[node] or (lo, hi, w) == bins[-1]:
                    break
                below[node] += w
            ends[node] = (lo, hi)
            if lo == hi:
                found[node] = (lo, below[node], w)
                del ends[node]
    return found


def grow(rows: DataFrame, shards: int, slack: float) -> Node:
    """The tree over the points."""
    root = Node(0, shards)
    open_ = [root]
    span: dict[str, int] = {}
    shift = {"by_size": 32, "by_word": 32, "by_sum": 14}
    while open_ := [n for n in open_ if n.leaves > 1]:
        number = {n.first: n for n in open_}
        placed = rows.withColumn("node", root.place(lambda n: F.lit(n.first)))
        stats = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("size").alias("w"), *[f(k).alias(f"{p}_{k}") for k in KEYS for p, f in (("lo", F.min), ("hi", F.max))]).collect()}
        if not span:
            if not stats:
                return root
            span = {k: max(1, (stats[0][f"hi_{k}"] >> shift[k]) - (stats[0][f"lo_{k}"] >> shift[k])) for k in KEYS}
        open_ = [n for n in open_ if n.first in stats]
        if not open_:
            break
        goal, ends = {}, {}
        for n in open_:
            r = stats[n.first]
            n.key = max(KEYS, key=lambda k: ((r[f"hi_{k}"] >> shift[k]) - (r[f"lo_{k}"] >> shift[k])) / span[k])
            goal[n.first] = r["w"] * (n.leaves // 2) // n.leaves
            ends[n.first] = (r[f"lo_{n.key}"], r[f"hi_{n.key}"])
        key = F.lit(None).cast("long")
        for k in KEYS:
            if own := [n.first for n in open_ if n.key == k]:
                key = F.when(F.col("node").isin(own), F.col(k)).otherwise(key)
        cuts = weighted_cuts(placed, key, "long", goal, ends, dict.fromkeys(goal, 0))
        torn = {}
        for n in open_:
            value, before, weight = cuts[n.first]
            leaf = stats[n.first]["w"] / n.leaves
            short, over = goal[n.first] - before, before + weight - goal[n.first]
            n.cut = value if short <= over else value + 1
            if min(short, over) > slack * leaf:
                torn[n.first] = (value, before)
        if torn:
            inside = placed.where(F.col("node").isin(list(torn))).where(key == lookup({k: str(v) for k, (v, _) in torn.items()}, "long"))
            spans = {r["node"]: (int(r["lo"]), int(r["hi"])) for r in inside.groupBy("node").agg(F.min("id_key").alias("lo"), F.max("id_key").alias("hi")).collect()}
            ids = weighted_cuts(inside, F.col("id_key"), "decimal(20,0)", goal, spans, {k: b for k, (_, b) in torn.items()})
            for node, (value, before, weight) in ids.items():
                n = number[node]
                n.cut = torn[node][0]
                n.cut_id = value if goal[node] - before <= before + weight - goal[node] else value + 1
        for n in open_:
            n.left, n.right = Node(n.first, n.leaves // 2), Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2)
        open_ = [c for n in open_ for c in (n.left, n.right)]
    return root


def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", slack: float = 0.03) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; slots count a
    shard's rows from 0 without gaps."""
    rows = written(points(docs, doc_id, text), "points")
    tree = grow(rows, shards, slack)
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_BUCKETS))
    placed = rows.select("doc_id", "size", "text_crc32", tree.place(lambda n: F.lit(n.first)).alias("shard"), bucket.alias("bucket"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    # at most shards x SLOT_BUCKETS rows of starts
    return (placed.withColumn("place", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot")))
