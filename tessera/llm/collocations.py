"""Phrase collocation mining by best-first branch and bound.

Everything is per language (null: ``und``).  A phrase's score is the
least, over its cuts, of a * n / (l * r): a its occurrences, l and r
those of the two parts, n all words.  As a <= min(l, r), no cut scores
above n / max(l, r); so a phrase scores at most n / f of its first word
and n / f of its last, which is known from the counts of words alone.

The frontier is the words that begin or end phrases, best bound (rarest
word) first.  One round takes a further part of it and grows phrases word
by word: a pass over the texts counts the phrases of k + 1 words that
begin or end with a word of the frontier, unless their first or last k
words are known to be too rare (a part is never rarer than the whole).
After each pass the ``top``-th score of the phrases that are known to
survive is a threshold that the result cannot fall below: words whose
bound lies under it leave the frontier, also for the phrases already
begun, and the rounds end when it lies above the bound of every word not
yet taken (ties included).

A phrase survives if no longer one with as many occurrences contains it.
It is enough to look one word further on either side: every phrase
between the two has as many.  Parts begin or end with a phrase's own
first or last word, so whatever a phrase of the frontier is judged by has
been counted with it.

What is known to be frequent is shipped to the tasks as a bit table of
``bits`` bits (fixed, whatever the corpus): a wrong "frequent" only costs
work, as counts are made by the phrases themselves.  Pairs of words, by far
the most phrases, are counted by their hashes first (two longs a row); only
those whose hash occurs often enough are then written out as texts and
counted.  The driver holds counts by frequency class, and these tables.

Defined results: null and empty texts have no words; null language is
``und`` (and joins it); repeated rows count each; ties are cut by
occurrences, then by the phrase's UTF-8 bytes; a phrase that a row does
not hold within one piece does not occur; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytetext import U, Slices, Words, chunks, mix, text_buffer
from tessera.llm.common import pick, written
from tessera.session import ship_package

BITS = 1 << 26
SLICE = 1_000_000  # bytes of text that are counted together
HELD = 1 << 19  # hashes that a task holds before it adds up equal ones
#: Words of a language that the first round takes; each further one takes eight times as many.
FIRST = 1 << 16
WIDE = "decimal(38,0)"

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
SEPARATOR = BREAK.copy()
SEPARATOR[[0x20, 0x09]] = True


class Pieces:
    """Words of lower-cased texts with the piece and the language of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = text_buffer(texts)
        self.data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
        self.words = w = Words(self.data, offsets, SEPARATOR)
        breaks = np.cumsum(BREAK[self.data])[w.start] if len(w) else np.zeros(0, np.int64)
        # words that follow each other without a break in one text; run[i]: words from i to the end of the piece
        n = len(w)
        last = np.ones(n, bool)
        last[:-1] = (breaks[1:] != breaks[:-1]) | (w.doc[1:] != w.doc[:-1])
        ends = np.flatnonzero(last)
        self.run = ends[np.searchsorted(ends, np.arange(n))] + 1 - np.arange(n) if n else np.zeros(0, np.int64)
        names = langs.fill_null("und").dictionary_encode()
        self.lang = np.asarray(names.indices)[w.doc] if n else np.zeros(0, np.int64)
        self.names = names.dictionary.to_pylist()
        seeds = [int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "little") for name in self.names]
        self.seed = mix(np.array(seeds + [0], U) + U(0x9E3779B97F4A7C15))
        self.slices = Slices(w.hashes()) if n else None

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """Of the k words from each of ``at`` on, with their language."""
        if not len(at):
            return np.zeros(0, U)
        return mix(self.slices.hash(at, at + k) ^ self.seed[self.lang[at]])

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        """The k words from each of ``at`` on, joined by one space."""
        i = (at[:, None] + np.arange(k)).reshape(-1)
        start, size = self.words.start[i], self.words.end[i] - self.words.start[i] + 1
        size[k - 1::k] -= 1
        out = np.cumsum(size) - size
        index = np.repeat(start - out, size) + np.arange(size.sum())
        data = self.data[np.minimum(index, max(len(self.data) - 1, 0))].copy()
        space = np.ones(len(i), bool)
        space[k - 1::k] = False
        data[(out + size - 1)[space]] = 32
        offsets = np.append(out[::k], size.sum()).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


class Bits:
    """A set of hashes that may hold more than was put in."""

    def __init__(self, blob: np.ndarray):
        self.blob = blob

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % U(len(self.blob) * 8)
        return (self.blob[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 > 0


def phrase_hashes(phrases: DataFrame) -> DataFrame:
    """(h): the hash of each (lang, phrase) row, as ``Pieces`` has it."""
    def one(batches):
        for batch in batches:
            # a phrase is its own text: no break occurs in it
            p = Pieces(batch.column(1), batch.column(0))
            at = p.words.first[:-1]
            k = np.diff(p.words.first)
            h = np.zeros(len(at), U)
            for size in np.unique(k):
                h[k == size] = p.hashes(at[k == size], int(size))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return phrases.select("lang", "phrase").mapInArrow(one, "h long")


def bit_table(hashes: DataFrame, bits: int):
    """The table of (h) rows, as a broadcast of bits / 8 bytes.

    Each task holds the blocks of 8 kB that its rows fall in, bits / 8
    bytes at most, however many rows there are."""
    step = 1 << 16

    def one(batches):
        for batch in batches:
            place = (batch.column(0).to_numpy().view(U) % U(bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place // step).astype(np.int32)), pa.array((place % step).astype(np.int32))], ["block", "at"])

    def fold(batches):
        cells: dict[int, np.ndarray] = {}
        for batch in batches:
            block, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(block, kind="stable")
            block, at = block[order], at[order]
            ends = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else []
            for lo, hi in zip(ends[:-1], ends[1:]):
                mine = cells.setdefault(int(block[lo]), np.zeros(step // 8, np.uint8))
                np.bitwise_or.at(mine, at[lo:hi] >> 3, np.uint8(1) << (at[lo:hi] & 7).astype(np.uint8))
        if cells:
            yield pa.RecordBatch.from_arrays([pa.array(list(cells), pa.int32()), pa.array([c.tobytes() for c in cells.values()], pa.binary())], ["block", "bits"])

    places = hashes.select("h").mapInArrow(one, "block int, at int")
    out = np.zeros(max(bits, step) // 8, np.uint8)
    for row in places.repartition("block").mapInArrow(fold, "block int, bits binary").collect():  # bits / 8 bytes in all
        out[row["block"] * step // 8:(row["block"] + 1) * step // 8] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out[:bits // 8])


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of single words."""
    return count(docs, 1, None, None, None)


def places(p: Pieces, k: int, frontier, known, eligible) -> np.ndarray:
    """Where phrases of k words begin that begin or end with a word of the
    frontier and whose parts of k - 1 words may be frequent.

    A part is known to be rare if it has been counted (it begins or ends
    with a word that the pass before took: ``eligible``) and is not in
    ``known``."""
    at = np.flatnonzero(p.run >= k)
    if k == 1:
        return at
    word = p.hashes(np.arange(len(p.words)), 1)
    front = Bits(frontier.value).holds(word)
    at = at[front[at] | front[at + k - 1]]
    table, told = Bits(known.value), Bits(eligible.value).holds(word)
    for part in (0, 1):
        first = at + part
        counted = told[first] | told[first + k - 2]
        at = at[~counted | table.holds(p.hashes(first, k - 1))]
    return at


def added(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes and the sums of their counts."""
    h, f = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h)
    h, f = h[order], f[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(f, first) if len(h) else f


def frequent_hashes(docs: DataFrame, k: int, frontier, known, eligible, least: int) -> DataFrame:
    """(h) of the phrases of k words at ``places`` whose hash occurs
    ``least`` times or more.  Equal ones of a task are added up before the
    shuffle; a task holds ``HELD`` of them and one slice at most."""
    def run(batches):
        hs, fs, held = [], [], 0
        for batch in chunks(batches, "text", SLICE):
            p = Pieces(batch.column(1), batch.column(0))
            h, f = np.unique(p.hashes(places(p, k, frontier, known, eligible), k), return_counts=True)
            hs.append(h)
            fs.append(f)
            held += len(h)
            if held >= HELD:
                h, f = added(hs, fs)
                hs, fs, held = [h], [f], len(h)
                if held >= HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(f)], ["h", "f"])
                    hs, fs, held = [], [], 0
        if hs:
            h, f = added(hs, fs)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(f)], ["h", "f"])

    parts = docs.select("lang", "text").mapInArrow(run, "h long, f long")
    return parts.groupBy("h").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("h")


def count(docs: DataFrame, k: int, frontier, known, eligible, often=None) -> DataFrame:
    """(lang, phrase, f) of the phrases of k words at ``places``, but for
    those whose hash is not in ``often``."""
    def run(batches):
        for batch in chunks(batches, "text", SLICE):
            p = Pieces(batch.column(1), batch.column(0))
            at = places(p, k, frontier, known, eligible)
            h = p.hashes(at, k)
            if often is not None:
                stay = Bits(often.value).holds(h)
                at, h = at[stay], h[stay]
            _, first, f = np.unique(h, return_index=True, return_counts=True)
            at = at[first]
            lang = pa.array(p.names + ["und"]).take(pa.array(p.lang[at].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), p.phrases(at, k), pa.array(f.astype(np.int64))], ["lang", "phrase", "f"])

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def cut(k: int):
    """The phrase's first k words, and the rest."""
    return F.substring_index("phrase", " ", k), F.substring_index("phrase", " ", F.col("words") - k)


def scored(counts: DataFrame, candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of the candidates (lang,
    phrase, f, words), by the counts of their parts."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "right", F.expr("substring_index(phrase, ' ', k - words)"))
    parts = counts.select(F.col("lang").alias("lang_"), F.col("phrase").alias("part"), "f")
    l, r = parts.toDF("ll", "lp", "l"), parts.toDF("rl", "rp", "r")
    both = (cuts.join(l, (F.col("lang") == F.col("ll")) & (F.col("left") == F.col("lp")))
            .join(r, (F.col("lang") == F.col("rl")) & (F.col("right") == F.col("rp"))))
    both = both.join(F.broadcast(sizes.withColumnRenamed("lang", "sl")), F.col("lang") == F.col("sl"))
    # exact beyond 64 bits: 1000 * a * n and l * r as whole decimals
    over = F.col("f").cast("decimal(17,0)") * F.col("n").cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")
    under = F.col("l").cast("decimal(17,0)") * F.col("r").cast("decimal(17,0)")
    both = both.withColumn("over", over.cast(WIDE)).withColumn("under", under.cast(WIDE)).withColumn(
        "score", F.expr("(over div under)").cast("long"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", "words", "f", "n").agg(best).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "best.l", "best.r", "n", "best.score")


def surviving(candidates: DataFrame, longer: DataFrame) -> DataFrame:
    """Candidates that no phrase one word longer with as many occurrences
    contains.  ``longer``: frequent phrases (lang, phrase, f, words)."""
    inner = longer.where("words > 2").select(
        F.col("lang").alias("dl"), F.col("f").alias("df"),
        F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("dp"))
    return candidates.join(inner, (F.col("lang") == F.col("dl")) & (F.col("phrase") == F.col("dp")) & (F.col("df") >= F.col("a")), "left_anti")


def top_of(survivors: DataFrame, top: int) -> DataFrame:
    """rank and the rows of each language's first ``top``.

    Each of 64 parts of a language is cut to its first ``top`` before they
    meet, so a hot language is many groups."""
    from pyspark.sql import Window

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = survivors.withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top).drop("salt")


def mine(docs: DataFrame, top: int = 2000, least: int = 100, longest: int = 5, lang: str = "lang", text: str = "text",
         bits: int = BITS, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), numbers as longs."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = pick(docs, lang=lang, text=text).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = written(count_words(docs), "words")
    sizes = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    frequent = words.where(F.col("f") >= least).withColumn("words", F.lit(1))
    # words of a language by classes of frequency, at most 1 + 4 * 63 of them, rarest first
    klass = F.floor(F.log2("f") * 4).cast("int")
    classes: dict[str, list[tuple[int, int]]] = {}
    for row in frequent.groupBy("lang", klass.alias("class")).agg(F.count("*").alias("c")).orderBy("lang", "class").collect():
        classes.setdefault(row["lang"], []).append((row["class"], row["c"]))
    n = {row["lang"]: row["n"] for row in sizes.collect()}
    known_words = bit_table(phrase_hashes(frequent), bits)
    floor = {name: 0 for name in classes}  # the top-th surviving score of a language, as far as known
    taken = {name: -1 for name in classes}  # highest class of the frontier
    room = first
    while True:
        open_ = False
        for name, parts in classes.items():
            more = [(c, k) for c, k in parts if c > taken[name]]
            # the best bound of a class is that of its least frequency
            if not more or 1000 * n[name] < floor[name] * 2 ** (more[0][0] / 4) * (1 - 1e-9):
                continue
            open_, filled = True, 0
            for c, k in more:
                if filled and filled + k > room:
                    break
                taken[name], filled = c, filled + k
        if not open_:
            break
        tables = [frequent]
        told, known, eligible = frequent, known_words, None
        survivors = None
        for k in range(2, longest + 1):
            front = frontier(spark, frequent, klass, taken, floor, n)
            front_bits = bit_table(phrase_hashes(front), bits)
            if k == 2:
                eligible = known_words  # all words have been counted
            often = bit_table(frequent_hashes(docs, k, front_bits, known, eligible, least), bits) if k == 2 else None
            grams = count(docs, k, front_bits, known, eligible, often).where(F.col("f") >= least).withColumn("words", F.lit(k))
            grams = written(grams, f"phrases{k}")
            tables.append(grams)
            known, eligible = bit_table(phrase_hashes(grams), bits), front_bits
            counts = tables[0]
            for more_counts in tables[1:]:
                counts = counts.unionByName(more_counts)
            # phrases of k - 1 words are settled by those of k words, the longest at once
            settled = [t for i, t in enumerate(tables, 1) if 1 < i < k or i == k == longest]
            for i in [k - 1] * (k > 2) + [k] * (k == longest):
                both_ends = ends_in(tables[i - 1], front)
                new = written(surviving(scored(counts, both_ends, sizes), counts), "scored")
                survivors = new if survivors is None else survivors.unionByName(new)
            if settled and survivors is not None:
                for row in top_of(survivors, top).where(F.col("rank") == top).select("lang", "score").collect():
                    floor[row["lang"]] = max(floor[row["lang"]], row["score"])
        result = survivors
        room *= 8
    if not classes or longest < 2:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    return top_of(result, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def frontier(spark, frequent: DataFrame, klass, taken: dict[str, int], floor: dict[str, int], n: dict[str, int]) -> DataFrame:
    """The words taken so far whose bound still reaches the threshold."""
    limits = [(name, taken[name], Decimal(1000 * n[name] // floor[name]) if floor[name] else None) for name in taken]
    table = spark.createDataFrame(limits, "fl string, upto int, most decimal(38,0)")
    return frequent.join(F.broadcast(table), F.col("lang") == F.col("fl")).where(
        (klass <= F.col("upto")) & (F.col("most").isNull() | (F.col("f") <= F.col("most")))).select("lang", "phrase")


def ends_in(grams: DataFrame, front: DataFrame) -> DataFrame:
    """The phrases whose first and last words are in the frontier."""
    w = front.select(F.col("lang").alias("wl"), F.col("phrase").alias("w"))
    firsts, lasts = w.toDF("l1", "w1"), w.toDF("l2", "w2")
    return (grams.join(firsts, (F.col("lang") == F.col("l1")) & (F.substring_index("phrase", " ", 1) == F.col("w1")), "left_semi")
            .join(lasts, (F.col("lang") == F.col("l2")) & (F.substring_index("phrase", " ", -1) == F.col("w2")), "left_semi"))
