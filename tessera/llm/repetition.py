"""Repetition rules from a suffix array over the words of each text.

A suffix array with its longest-common-prefix (LCP) values lists every
repeated word sequence of a text: the LCP intervals.  The deepest
interval that holds a suffix has the larger of the two LCP values beside
it, which is the length of the longest repeat starting at that word;
no longer span there occurs twice, so these spans are the maximal
repeats.  Their union gives the covered share of the text.

One array covers a whole batch: the first word of a suffix is ranked
together with its text, so suffixes of different texts never meet.
Prefix doubling sorts only suffixes that are still tied, and the ranks
of each doubling step give the LCP values by binary descent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.bytetext import U, Slices, Words, chunks, mix, text_buffer
from tessera.llm.common import pick
from tessera.session import ship_package

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
DOC_STEP = 0xD6E8FEB86659FD93


def in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mix(h ^ (doc.astype(U) + U(1)) * U(DOC_STEP))


def suffix_array(keys: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes and the ranks by their first 1, 2, 4, ... keys.

    end[i]: where the text of position i ends.  A rank is the place of the
    first suffix that shares it.
    """
    n = len(keys)
    order = np.argsort(keys)
    ranked = keys[order]
    head = np.ones(n, bool)
    head[1:] = ranked[1:] != ranked[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, step = [rank], 1
    tied = order[~(head & np.append(head[1:], True))]
    while len(tied):
        after = tied + step
        inside = after < end[tied]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        by = np.argsort(key)
        tied, key, old = tied[by], key[by], rank[tied[by]]
        at = np.arange(len(tied))
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        place = old + at - np.maximum.accumulate(np.where(group, at, 0))
        head = np.ones(len(tied), bool)
        head[1:] = key[1:] != key[:-1]
        order[place] = tied
        rank = rank.copy()
        rank[tied] = place[np.maximum.accumulate(np.where(head, at, 0))]
        levels.append(rank)
        tied = tied[~(head & np.append(head[1:], True))]
        step *= 2
    return order, levels


def longest_repeats(keys: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, the most keys from there on that occur again in
    the same text (0 if not even the first does)."""
    n = len(keys)
    order, levels = suffix_array(keys, end)
    pair = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) if n else np.zeros(0, np.int64)
    a, b = order[pair], order[pair + 1]
    lcp = np.zeros(len(pair), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        same = (x < end[a]) & (y < end[b])
        same &= levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)]
        lcp += same * (1 << j)
    longest = np.zeros(n, np.int64)
    longest[a] = lcp  # each suffix is at most once the upper of a pair
    longest[b] = np.maximum(longest[b], lcp)
    return longest


def union(longest: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of at least ``least`` keys."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    edges = np.bincount(at, minlength=n + 1) - np.bincount(at + longest[at], minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "longest_repeat long, covered_chars long, repeats array<struct<start:long,words:long>>")


def measure(column: pa.Array, min_repeat: int) -> list[pa.Array]:
    """The columns of SCHEMA after doc_id for a column of texts."""
    data, offsets = text_buffer(column)
    w = Words(data, offsets)
    end = w.first[w.doc + 1] if len(w) else np.zeros(0, np.int64)
    longest = longest_repeats(in_doc(w.hashes(), w.doc), end)
    inside = np.zeros(len(data) + 1, np.int64)
    inside[1:] = np.cumsum((data & 0xC0) != 0x80)
    chars = inside[w.end] - inside[w.start]
    covered = union(longest, min_repeat)

    lines = Words(data, offsets, NEWLINE)
    visible = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    doc = lines.doc[visible]
    hashes = Slices.hash(w.slices(), lines.start[visible], lines.end[visible])
    _, once = np.unique(in_doc(hashes, doc), return_index=True)
    n = len(offsets) - 1
    dup_lines = np.bincount(doc, minlength=n) - np.bincount(doc[once], minlength=n)

    most = np.zeros(n, np.int64)
    np.maximum.at(most, w.doc, longest)
    # a repeat that lies inside the one from the word before is not maximal
    maximal = longest >= min_repeat
    if len(w):
        maximal[1:] &= (longest[1:] + 1 != longest[:-1]) | (w.doc[1:] != w.doc[:-1])
    rows = np.flatnonzero(maximal)
    struct = pa.StructArray.from_arrays([pa.array(rows - w.first[w.doc[rows]]), pa.array(longest[rows])], ["start", "words"])
    first = np.searchsorted(rows, w.first)
    weight = np.concatenate([[0], np.cumsum(chars * covered, dtype=np.int64)])
    total = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    return [pa.array(np.diff(w.first).astype(np.int64)), pa.array(np.diff(total[w.first])), pa.array(per_text(SYMBOLS[data], offsets)),
            pa.array(dup_lines.astype(np.int64)), pa.array(per_text(union(longest, 5), w.first)), pa.array(most),
            pa.array(np.diff(weight[w.first])), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), struct)]


def repetition(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_repeat: int = 10,
               max_share: float = 0.25, max_longest: int = 100) -> DataFrame:
    """Repetition measures and verdict of every whole text.

    ``repeats`` lists the maximal repeats of at least ``min_repeat`` words
    (start in words, length); ``covered_chars`` counts the word characters
    in their union.  ``kept`` is false for fewer than 10 words, more than
    20 % of words in repeated 5-word windows, more than ``max_share`` of
    the word characters covered, or a repeat longer than ``max_longest``.

    Null and empty texts have no words and are not kept.  Texts of any
    length are sorted whole.  Repeated rows are judged each by itself, an
    empty table gives an empty result, a null id stays null, and other
    columns of the input are not read.
    """
    from pyspark.sql import functions as F

    ship_package(docs.sparkSession)

    def run(batches):
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *measure(batch.column(1), min_repeat)],
                                             [f.split(" ")[0] for f in SCHEMA.replace("start:long,words:long", "").split(", ")])

    out = pick(docs, doc_id=doc_id, text=text).mapInArrow(run, SCHEMA)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    fine = (F.col("covered_chars") <= max_share * F.col("word_chars")) & (F.col("longest_repeat") <= max_longest)
    return out.withColumns({"base_failed": base, "kept": ~base & fine})
