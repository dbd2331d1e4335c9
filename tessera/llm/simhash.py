"""SimHash near-duplicates by tiled exact comparison.

A fingerprint bit is set if over half of the text's shingle hashes have
it.  Distinct fingerprints are sorted into tiles by population count;
two fingerprints differ in at least as many bits as their counts do, so
tile pairs whose counts are further apart than the radius are skipped.
The others are compared exactly with exclusive-or and bit counts.  Inside
a tile pair the same bound holds for the summed differences of the
quarters' counts, which skips most blocks of the pair.

A cell (tile pair) returns its links as stars around the smallest
fingerprint of each local group, so a group of any size gives at most as
many links as the cell has fingerprints.  Nothing but the 65 counts of
the population histogram reaches the driver.

Defined results: null and empty texts have fingerprint 0, linked like
any other; texts under the shingle length are one shingle; a group's id
is its smallest non-null id (null if it has none); repeated rows get
equal results; an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytetext import chunks
from tessera.llm.common import pick, written
from tessera.llm.components import components
from tessera.session import ship_package

SEED, TILE = 42, 1 << 15


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[lo:lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of each whole text, as a long;
    and the columns ``keep`` of the row as c0, c1, ..."""
    ship_package(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text, **{f"c{i}": c for i, c in enumerate(keep)})

    def run(batches):
        for batch in chunks(batches, "text"):
            texts = batch.column(1).cast(pa.large_binary())
            got = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(got.view(np.int64)), *batch.columns[2:]],
                                             ["doc_id", "fp", *batch.schema.names[2:]])

    kept = [F.col(c) for c in source.columns[2:]]
    return source.mapInArrow(run, source.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("fp"), *kept).schema)


def layout(counts: dict[int, int], tile: int, radius: int) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int, int]]]:
    """For each population count its first tile and number of tiles; for
    each tile the first and last tile within the radius.  Neighbouring
    rare counts share a tile."""
    place, low, high, filled = {}, [], [], 0
    for p in sorted(counts):
        if filled and filled + counts[p] <= tile:
            filled += counts[p]
            place[p] = (len(low) - 1, 1)
            high[-1] = p
            continue
        parts = -(-counts[p] // tile)
        place[p] = (len(low), parts)
        low += [p] * parts
        high += [p] * parts
        filled = counts[p] if parts == 1 else 0
    reach = [(t, int(np.searchsorted(high, low[t] - radius)), int(np.searchsorted(low, high[t] + radius, "right")) - 1) for t in range(len(low))]
    return place, reach


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each a position with a label of at most itself) after
    linking positions a and b."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nearer := label[label], label):
            label = nearer


def quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def compare(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Star links (fingerprint, smallest of its local group) of a cell:
    all of ``a`` against all of ``b`` (or within ``a``, if same)."""
    nodes = np.unique(a if same else np.concatenate([a, b]))
    label = np.arange(len(nodes))
    sides = []
    for fp in (a, b):
        code = quarters(fp) @ np.array([17 ** 3, 17 ** 2, 17, 1])
        order = np.argsort(code, kind="stable")
        code, first = np.unique(code[order], return_index=True)
        bounds = np.append(first, len(fp))
        sides.append((fp[order], np.searchsorted(nodes, fp[order]), bounds, quarters(fp[order][first])))
    (fa, na, ba, qa), (fb, nb, bb, qb) = sides
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0
    for g in range(len(ba) - 1):
        near = np.flatnonzero(np.abs(qb - qa[g]).sum(1) <= radius)
        size = bb[near + 1] - bb[near]
        cols = np.repeat(bb[near] - np.cumsum(size) + size, size) + np.arange(size.sum())
        right = fb[cols]
        step = max(1, (1 << 21) // max(1, len(cols)))
        for lo in range(ba[g], ba[g + 1], step):
            left = fa[lo:min(lo + step, ba[g + 1])]
            i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
            x, y = na[lo + i], nb[cols[j]]
            other = x < y if same else x != y
            if other.any():
                held.append((x[other], y[other]))
                n_held += int(other.sum())
                if n_held > 1 << 20:
                    label = join_labels(label, *map(np.concatenate, zip(*held)))
                    held, n_held = [], 0
    if held:
        label = join_labels(label, *map(np.concatenate, zip(*held)))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(u, v): links whose components are those of all pairs of ``fp``
    within the radius."""
    spark = distinct.sparkSession
    count = F.bit_count("fp")
    counts = {r["p"]: r["n"] for r in distinct.groupBy(count.alias("p")).agg(F.count("*").alias("n")).collect()}
    place, reach = layout(counts, tile, radius)
    places = spark.createDataFrame([(p, *where) for p, where in place.items()], "p int, first int, parts int")
    reaches = spark.createDataFrame(reach, "tile int, low int, high int")
    tiles = (distinct.withColumn("p", count).join(F.broadcast(places), "p")
             .select((F.col("first") + F.pmod(F.xxhash64("fp"), F.col("parts"))).cast("int").alias("tile"), "fp")
             .groupBy("tile").agg(F.collect_list("fp").alias("fps")).join(F.broadcast(reaches), "tile"))
    cells = tiles.select("tile", "fps", F.explode(F.sequence("low", "high")).alias("other")).select(
        F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fps")

    def cell(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        side = {t: np.asarray(f, np.int64).view(np.uint64) for t, f in zip(pdf["tile"], pdf["fps"])}
        u, v = compare(side[key[0]], side[key[1]], radius, key[0] == key[1])
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return cells.groupBy("a", "b").applyInPandas(cell, "u long, v long")


def grouped(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, id, root) of each distinct fingerprint of ``rows``: its smallest
    doc_id, and the fingerprint that names its group."""
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct")
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    linked = grouped(rows, radius)
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id")).withColumnRenamed("root", "r")
    per_fp = linked.join(smallest, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return rows.join(per_fp, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The columns ``keep`` (of orderable types) of one row of each group:
    the one with the smallest id, then fingerprint, then row.  Rows that
    share an id but not a group do not touch each other; rows without an
    id stay."""
    rows = written(fingerprints(docs, doc_id, text, shingle, tuple(keep)), "fingerprints")
    first = grouped(rows, radius).where("id is not null").groupBy("root").agg(
        F.min(F.struct("id", "fp")).alias("m")).select(F.col("m.id").alias("kept_id"), F.col("m.fp").alias("kept_fp"))
    cells = [f"c{i}" for i in range(len(keep))]
    named = rows.join(first, (F.col("doc_id") == F.col("kept_id")) & (F.col("fp") == F.col("kept_fp")))
    named = named.groupBy("doc_id", "fp").agg(F.min(F.struct(*cells)).alias("m")).select(*[F.col(f"m.{c}").alias(c) for c in cells])
    return named.unionByName(rows.where("doc_id is null").select(*cells)).toDF(*keep)
