"""Translation edit rate with block shifts.

A shift takes a block of the hypothesis that equals some words of the
reference and puts it where it aligns with them as a whole; it counts one
edit, whatever its length and distance.  Greedily the shift that leaves
the fewest word edits is taken, until none leaves fewer than before.

What a shift leaves follows from edit tables: with the block at words j to
j + L of the reference and behind p words of the rest, it is the distance
of those p words to the first j words, plus that of the others to the words
from j + L on.  On one side of the block these are rows of the hypothesis's
own tables, on the other they go on from one of them.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import ter_tokens
from tessera.operators.genmetrics import edit_distance
from tessera.plans.ranking import cluster
from tessera.session import ship_package

# Fixed values of the metric's public definition: words of a block, and words
# that it may move, at most.
LONGEST, FARTHEST = 10, 50
#: blocks tried together
AT_ONCE = 2


def go_on(row: np.ndarray, words: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """[k, t, j]: ``row[k]``, a row of edits to the first j of ``refs[k]``,
    after the first t of ``words[k]`` more."""
    k, n = words.shape
    ks, ts = np.arange(refs.shape[1] + 1, dtype=row.dtype), np.arange(n + 1, dtype=row.dtype)
    # counted less t + j, so that a word more on one side costs nothing, one
    # word in place of another -1, and the same word on both sides -2
    cost = np.negative((words.T[:, :, None] == refs[None, :, :]).astype(row.dtype) + row.dtype.type(1))
    out = np.empty((n + 1, k, len(ks)), row.dtype)
    out[0] = row - ks
    out[1:, :, 0] = out[0, :, 0]
    for p in range(n):
        t = out[p + 1, :, 1:]
        np.add(out[p, :, :-1], cost[p], out=t)
        np.minimum(t, out[p, :, 1:], out=t)
        np.minimum(t[:, 0], out[p + 1, :, 0], out=t[:, 0])
        np.minimum.accumulate(t, axis=1, out=t)
    out += ks + ts[:, None, None]
    return out.swapaxes(0, 1)


def best_shift(hyp: np.ndarray, ref: np.ndarray, edits: int, floor: int = 0) -> tuple[int, int, int, int] | None:
    """(edits left, start, length, new place among the rest) of the shift
    that leaves the fewest, under ``edits``; of several the longest, then
    the first by start and place.  No order of the words leaves under
    ``floor``.

    The block saves at most its own words beside the edits of the rest, so
    blocks are tried from the one that may leave the fewest; none that can
    no longer win is."""
    n, m = len(hyp), len(ref)
    kind = np.int16 if n + m < 1 << 14 else np.int32
    both = go_on(np.arange(m + 1, dtype=kind)[None, :].repeat(2, 0), np.stack([hyp, hyp[::-1]]), np.stack([ref, ref[::-1]]))
    ahead, behind = both[0], both[1, ::-1, ::-1]  # first p words and first j, words from p and from j on
    equal, hope = np.ones((n + 1, m + 1), bool), []
    blocks = {}
    for length in range(1, min(LONGEST, n - 1, m) + 1):
        # start in hyp, start in ref
        equal = equal[:-1, :-1] & (hyp[length - 1:, None] == ref[None, length - 1:])
        starts = np.flatnonzero(equal.any(1))
        if not len(starts):
            break
        blocks[length] = equal
        least = np.maximum((ahead[starts] + behind[starts + length]).min(1) - length, floor)
        hope += [(int(x), -length, int(s)) for x, s in zip(least, starts) if x < edits]
    hope.sort()
    best, lo = None, 0
    while lo < len(hope) and (best is None or hope[lo] < best):
        few = [x for x in hope[lo:lo + AT_ONCE] if x[:2] == hope[lo][:2]]
        lo += len(few)
        length = -few[0][1]
        starts = [s for _, _, s in few]
        # the words behind the block go before it, or those before it behind it
        far = min(FARTHEST, max(max(s, n - length - s) for s in starts))
        words = np.full((2 * len(few), far), -1, np.int64)
        for i, s in enumerate(starts):
            right, left = hyp[s + length:s + length + far], hyp[max(0, s - far):s][::-1]
            words[2 * i, :len(right)], words[2 * i + 1, :len(left)] = right, left
        rows = np.stack([x for s in starts for x in (ahead[s], behind[s + length, ::-1])])
        more = go_on(rows, words, np.stack([ref, ref[::-1]] * len(few)))
        for i, s in enumerate(starts):
            j = np.flatnonzero(blocks[length][s])
            right, left = min(far, n - length - s), min(far, s)
            later = more[2 * i, 1:right + 1][:, j] + behind[s + length + 1:s + length + 1 + right][:, j + length]
            sooner = ahead[s - left:s][:, j] + more[2 * i + 1, left:0:-1, ::-1][:, j + length]
            per_place = np.concatenate([sooner, later]).min(1)
            at = int(per_place.argmin())
            found = (int(per_place[at]), -length, s, s - left + at + (at >= left))
            if found[0] < edits and (best is None or found < best):
                best = found
    return best and (best[0], best[2], -best[1], best[3])


def shifted_edits(hyp: list[str], ref: list[str]) -> tuple[int, int]:
    """(shifts, word edits that they leave)."""
    names: dict[str, int] = {}
    h = np.array([names.setdefault(t, len(names)) for t in hyp], np.int64)
    r = np.array([names.setdefault(t, len(names)) for t in ref], np.int64)
    edits, shifts = edit_distance(h, r), 0
    # words that the sides do not share are edits under any order
    common = (Counter(h.tolist()) & Counter(r.tolist())).total()
    floor = max(len(h), len(r)) - common
    while edits > floor and (found := best_shift(h, r, edits, floor)):
        left, start, length, place = found
        rest = np.delete(h, slice(start, start + length))
        h = np.concatenate([rest[:place], h[start:start + length], rest[place:]])
        edits, shifts = edit_distance(h, r), shifts + 1
    return shifts, edits


def edits_with_shifts(pairs: DataFrame, pred: str = "prediction", ref: str = "reference", key: str = "pair_id") -> DataFrame:
    """(key, shifts, edits, ref_words) of every pair."""
    ship_package(pairs.sparkSession)

    @F.pandas_udf("struct<shifts:long,edits:long>")
    def count(h: pd.Series, r: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shifted_edits(list(a), list(b)) for a, b in zip(h, r)], columns=["shifts", "edits"], dtype="int64")

    base = cluster(pairs, key).select(key, ter_tokens(pred).alias("_h"), ter_tokens(ref).alias("_r"))
    return base.select(key, count("_h", "_r").alias("_e"), F.size("_r").cast("long").alias("ref_words")).select(
        key, "_e.shifts", "_e.edits", "ref_words")


def translation_edit_rate(pairs: DataFrame, pred: str = "prediction", ref: str = "reference", key: str = "pair_id") -> DataFrame:
    """Corpus TER x 100 = (shifts + edits) / reference words."""
    per = edits_with_shifts(pairs, pred, ref, key)
    sums = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("shifts", "edits", "ref_words")])
    return sums.select("shifts", "edits", "ref_words", (F.lit(100.0) * (F.col("shifts") + F.col("edits"))
                                                        / F.greatest(F.col("ref_words"), F.lit(1))).alias("ter"))
