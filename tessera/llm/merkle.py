"""Merkle dataset manifest: a postorder append log.

A run of n leaves becomes a tree: every two consecutive nodes of a level
become their hash, an odd last one becomes the hash of itself, until one
is left.  Nodes are logged in the order in which a writer that appends
leaf after leaf completes them, which is postorder.  With

    before(x) = x + x // 2 + x // 4 + ...   nodes completed with x leaves
    size(m, k) = m + ceil(m / 2) + ... + ceil(m / 2**k)

the node of level k over the leaves from x = j * 2**k on, m of them,
stands at place before(x) + size(m, k) - 1.  Nothing but the number of
leaves is needed to address it.

1. Leaves are hashed in the JVM and ranked in their run by a distributed
   sort.
2. Builders, each aligned to 2**``height`` leaves, write their subtree's
   nodes in completion order: the segments of tier 0.  Their last nodes
   are the leaves of the next tier, whose builders do the same, until a
   run has one node left (its subroot).  The subroots are a run of their
   own; its last node is the root.
3. Proofs: each aligned block of leaves takes its siblings from its own
   segment by their places, then the path of its block from the tier
   above.  So a proof costs one join of a block with its segment, not a
   row for each sibling.

A hot run is many blocks; a builder never holds more than 2**height
leaves.  What reaches the driver are the counts of the tiers.

Defined results: null fields hash as ``-``; null and empty runs are runs
of their own; a null id comes first in its run; rows that repeat an id
are ordered by their leaf; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pick, written
from tessera.plans.ranking import global_rank
from tessera.session import ship_package

HEIGHT = 7  # a builder's subtree has at most 2**7 leaves
HEX = 64
LEAVES = "run long, block long, at long, n long, node string"
SEGMENT = "run long, tier int, block long, n long, m int, height int, first long, nodes binary"


def before(x: int) -> int:
    """Nodes that are complete when x leaves are."""
    total = 0
    while x:
        total += x
        x >>= 1
    return total


def size(m: int, k: int) -> int:
    """Nodes of a subtree of height k over m leaves."""
    return sum(-(-m >> i) for i in range(k + 1))


def depth(n: int) -> int:
    """Height of the tree over n leaves."""
    return max(0, n - 1).bit_length()


def place(k: int, j: int, n: int) -> int:
    """Where node j of level k stands in the log of n leaves."""
    x = j << k
    return before(x) + size(min(1 << k, n - x), k) - 1


def parent(left: str, right: str = "") -> str:
    return sha256((left + right).encode()).hexdigest()


def completed(leaves: list[str], height: int) -> list[str]:
    """The nodes of the tree over the leaves, in completion order; an
    incomplete tree is closed up to ``height``."""
    log: list[str] = []
    open_: list[str | None] = [None] * (height + 1)  # a left node that waits, by level
    for leaf in leaves:
        node = leaf
        log.append(node)
        for k in range(height):
            if open_[k] is None:
                open_[k] = node
                break
            node, open_[k] = parent(open_[k], node), None
            log.append(node)
    node = None  # the node of the level below that has just been closed
    for k in range(height):
        if node is None and open_[k] is not None:
            node = parent(open_[k])
        elif node is not None:
            node = parent(node) if open_[k] is None else parent(open_[k], node)
        if node is not None:
            log.append(node)
    return log


def siblings(log: bytes, i: int, m: int, height: int) -> list[tuple[bool, str]]:
    """(stands left, digest) of the siblings of leaf i of m, from a
    builder's log, addressed by their places."""
    out = []
    for k in range(height):
        other = (i >> k) ^ 1
        if other << k < m:
            at = place(k, other, m) * HEX
            out.append((other < i >> k, log[at:at + HEX].decode()))
    return out


def fold(leaf: str, path: list[tuple[bool, str]], steps: Iterator[bool]) -> str:
    """The digest that a leaf and its siblings lead to; ``steps`` says level
    by level whether there is a sibling."""
    rest = iter(path)
    for has in steps:
        if has:
            left, other = next(rest)
            leaf = parent(other, leaf) if left else parent(leaf, other)
        else:
            leaf = parent(leaf)
    return leaf


def steps(i: int, m: int, height: int) -> list[bool]:
    return [((i >> k) ^ 1) << k < m for k in range(height)]


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def build(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The log of every run: segments of aligned builders, tier by tier.

    leaves: (run, at, n, node), at from 0 gapless in each run of n leaves.
    A segment's ``nodes`` are hexadecimal digests in completion order.  In
    tier 0 they stand from place ``first`` on in the run's log, without
    gaps, up to the segment's own root."""
    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        run, block = int(key[0]), int(key[1])
        m, n = len(pdf), int(pdf["n"].iloc[0])
        top = min(height, depth(n))
        log = completed(pdf["node"].tolist(), top)
        return pd.DataFrame([(run, block, n, m, top, before(block << height), "".join(log).encode())],
                            columns=["run", "block", "n", "m", "height", "first", "nodes"])

    tiers, tier = [], 0
    rows = leaves.select("run", F.shiftright("at", height).alias("block"), "at", "n", "node")
    while True:
        segments = rows.groupBy("run", "block").applyInPandas(
            write, "run long, block long, n long, m int, height int, first long, nodes binary").withColumn("tier", F.lit(tier))
        segments = written(segments.select(*[f.split(" ")[0] for f in SEGMENT.split(", ")]), "log")
        tiers.append(segments)
        if not segments.where(F.col("n") > F.lit(1 << height)).limit(1).count():
            break
        last = F.substring("nodes", -HEX, HEX).cast("string")
        rows = segments.where(F.col("n") > F.lit(1 << height)).select(
            "run", F.shiftright("block", height).alias("block"), F.col("block").alias("at"),
            F.ceil(F.col("n") / F.lit(1 << height)).alias("n"), last.alias("node"))
        tier += 1
    log = tiers[0]
    for segments in tiers[1:]:
        log = log.unionByName(segments)
    return log


def roots(log: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(run, root) of every run of a log."""
    return log.where(F.col("n") <= F.lit(1 << height)).select("run", F.substring("nodes", -HEX, HEX).cast("string").alias("root"))


PATH = "side array<boolean>, path array<string>, steps array<boolean>"


def proofs(rows: DataFrame, log: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Adds side, path and steps to ``rows`` (run, at, ...; tier 0): the
    siblings level by level up to the run's root, whether each stands
    left, and for every level whether there is one."""
    highest = log.agg(F.max("tier")).first()[0]
    if highest is None:
        return rows.select("*", *[F.lit(None).cast(f.split(" ", 1)[1]).alias(f.split(" ")[0]) for f in PATH.split(", ")])

    def take(segments: DataFrame, wanted: DataFrame) -> DataFrame:
        """One tier's part of the paths of the leaves ``wanted`` (run, at, ...)."""
        schema = wanted.withColumns({"side": F.lit(None).cast("array<boolean>"), "path": F.lit(None).cast("array<string>"),
                                     "steps": F.lit(None).cast("array<boolean>")}).schema

        def extract(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(right) or not len(left):
                return pd.DataFrame(columns=schema.names)
            nodes, m, top = bytes(right["nodes"].iloc[0]), int(right["m"].iloc[0]), int(right["height"].iloc[0])
            index = [int(a) & ((1 << height) - 1) for a in left["at"]]
            found = [siblings(nodes, i, m, top) for i in index]
            return left.assign(side=[[s for s, _ in f] for f in found], path=[[d for _, d in f] for f in found],
                               steps=[steps(i, m, top) for i in index])[schema.names]

        keyed = wanted.withColumn("block", F.shiftright("at", height))
        return (keyed.groupBy("run", "block").cogroup(segments.groupBy("run", "block"))
                .applyInPandas(extract, schema))

    upper = None
    for tier in range(highest, 0, -1):  # the blocks of the tier below are this tier's leaves
        below = log.where(F.col("tier") == tier - 1).where(F.col("n") > F.lit(1 << height)).select("run", F.col("block").alias("at"))
        part = take(log.where(F.col("tier") == tier), below)
        upper = written(join_paths(part, upper, height), "paths")
    return join_paths(take(log.where(F.col("tier") == 0), rows), upper, height)


def join_paths(part: DataFrame, upper: DataFrame | None, height: int) -> DataFrame:
    """Appends the paths of the blocks to those inside the blocks."""
    if upper is None:
        return part
    names = part.columns
    above = upper.select(F.col("run").alias("run_"), F.col("at").alias("block_"), *[F.col(c).alias(f"{c}_") for c in ("side", "path", "steps")])
    both = part.join(above, (F.col("run") == F.col("run_")) & (F.shiftright("at", height) == F.col("block_")), "left")
    grown = {c: F.when(F.col(f"{c}_").isNull(), F.col(c)).otherwise(F.concat(c, f"{c}_")) for c in ("side", "path", "steps")}
    return both.select(*[grown.get(c, F.col(c)).alias(c) for c in names])


def manifest(docs: DataFrame, fields: list[str], run: str = "lang", doc_id: str = "doc_id", number: str = "n_chars",
             height: int = HEIGHT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, log, top): the ranked leaves of every row with their proof in
    the run and in the top tree; the log of all runs; the log of the runs'
    roots (one run, number 0).

    ``tampered`` is the leaf as it is when ``number`` grows by 1."""
    ship_package(docs.sparkSession)
    source = pick(docs, **{f"f{i}": c for i, c in enumerate(fields)}, doc_id=doc_id, lang=run)
    columns = [F.col(f"f{i}") for i in range(len(fields))]
    changed = [F.col(f"f{i}") + 1 if c == number else F.col(f"f{i}") for i, c in enumerate(fields)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = source.select("doc_id", "lang", digest(columns).alias("node"), F.when(chosen, digest(changed)).alias("tampered"))
    ranked = written(global_rank(leaves, ["doc_id", "node", "tampered"], ["lang"], "at"), "leaves")
    runs = global_rank(ranked.groupBy("lang").agg(F.count("*").alias("n")), ["lang"], None, "run")
    runs = written(runs.select(F.col("lang").alias("lang_"), "n", F.col("run").cast("long").alias("run")), "runs")
    ranked = ranked.join(runs, F.col("lang").eqNullSafe(F.col("lang_"))).drop("lang_")
    ranked = written(ranked.withColumn("at", F.col("at").cast("long")), "ranked")
    log = build(ranked.select("run", "at", "n", "node"), height)
    subroots = roots(log, height)
    n_runs = runs.count()
    top = build(subroots.select(F.lit(0).cast("long").alias("run"), F.col("run").alias("at"),
                                F.lit(n_runs).cast("long").alias("n"), F.col("root").alias("node")), height)
    root = roots(top, height).select("root").scalar()  # one row, none for an empty table
    over = proofs(subroots.select(F.lit(0).cast("long").alias("run"), F.col("run").alias("at"), F.col("root").alias("subroot")), top, height)
    over = over.select(
        F.col("at").alias("run_"), "subroot", root.alias("root"), *[F.col(c).alias(f"{c}_") for c in ("side", "path", "steps")])
    over = written(over, "top")
    rows = proofs(ranked.select("run", "at", "doc_id", "lang", "node", "tampered"), log, height)
    rows = rows.join(over, F.col("run") == F.col("run_")).select(
        "doc_id", "lang", "run", "at", F.col("node").alias("leaf"), "tampered", "subroot", "root",
        *[F.concat(c, f"{c}_").alias(c) for c in ("side", "path", "steps")])
    return rows, log, top


def verify(rows: DataFrame) -> DataFrame:
    """Adds folded_root and verified: what the tampered leaf, else the leaf,
    leads to with the row's siblings, and whether that is the root."""
    @F.pandas_udf("string")
    def folded(leaf: pd.Series, side: pd.Series, path: pd.Series, has: pd.Series) -> pd.Series:
        return pd.Series([fold(a, list(zip(s, p)), h) for a, s, p, h in zip(leaf, side, path, has)], dtype=object)

    out = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), "side", "path", "steps"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def log_rows(log: DataFrame) -> DataFrame:
    """(run, place, digest): tier 0 of a log node by node."""
    nodes = F.regexp_extract_all(F.col("nodes").cast("string"), F.lit(f"(.{{{HEX}}})"), F.lit(1))
    return log.where("tier = 0").select("run", "first", F.posexplode(nodes).alias("i", "digest")).select(
        "run", (F.col("first") + F.col("i")).alias("place"), "digest")
