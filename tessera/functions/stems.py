"""A suffix-stripping stemmer for English (the public algorithm of 1980),
as a table of rules: Python applies it to distinct tokens, ``sql_stem``
writes the same table as SQL."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# A y that is a consonant (at the start or after a vowel) is written Y.
C, V = "[^aeiouy]", "[aeiouy]"
M0 = f"^{C}*{V}+{C}"                     # at least one vowel-consonant run
M1 = f"^{C}*{V}+{C}+{V}*$"               # exactly one
M2 = f"^{C}*{V}+{C}+{V}+{C}"             # at least two
CVC = f"{C}{V}[^aeiouywxY]$"
#: Conditions on what stands before the suffix: alternatives of
#: (pattern, whether it must be found).
ANY: list = [[]]
SOME, MANY, VOWEL = [[(M0, True)]], [[(M2, True)]], [[(V, True)]]
SHORT = [[(M1, True), (CVC, True)]]

# The rules (suffix, condition, replacement[, otherwise]); in a
# step the first suffix that fits decides.  "|" marks a removed -ed or -ing.
STEPS: list[list[tuple]] = [
    [("sses", ANY, "ss"), ("ies", ANY, "i"), ("ss", ANY, "ss"), ("s", ANY, "")],
    [("eed", SOME, "ee"), ("ed", VOWEL, "|"), ("ing", VOWEL, "|")],
    [("at|", ANY, "ate"), ("bl|", ANY, "ble"), ("iz|", ANY, "ize"),
     *[(c + c + "|", ANY, c) for c in "bcdfghjkmnpqrtvwxY"], ("|", SHORT, "e", "")],
    [("y", VOWEL, "i"), ("Y", VOWEL, "i")],
    [("ational", SOME, "ate"), ("ization", SOME, "ize"), ("iveness", SOME, "ive"), ("fulness", SOME, "ful"),
     ("ousness", SOME, "ous"), ("tional", SOME, "tion"), ("biliti", SOME, "ble"), ("entli", SOME, "ent"),
     ("ousli", SOME, "ous"), ("ation", SOME, "ate"), ("alism", SOME, "al"), ("aliti", SOME, "al"), ("iviti", SOME, "ive"),
     ("enci", SOME, "ence"), ("anci", SOME, "ance"), ("izer", SOME, "ize"), ("abli", SOME, "able"), ("alli", SOME, "al"),
     ("ator", SOME, "ate"), ("eli", SOME, "e")],
    [("icate", SOME, "ic"), ("ative", SOME, ""), ("alize", SOME, "al"), ("iciti", SOME, "ic"), ("ical", SOME, "ic"),
     ("ness", SOME, ""), ("ful", SOME, "")],
    [("ement", MANY, ""), ("ance", MANY, ""), ("ence", MANY, ""), ("able", MANY, ""), ("ible", MANY, ""), ("ment", MANY, ""),
     ("ant", MANY, ""), ("ent", MANY, ""), ("ion", [[(M2, True), ("[st]$", True)]], ""), ("ism", MANY, ""), ("ate", MANY, ""),
     ("iti", MANY, ""), ("ous", MANY, ""), ("ive", MANY, ""), ("ize", MANY, ""), ("al", MANY, ""), ("er", MANY, ""),
     ("ic", MANY, ""), ("ou", MANY, "")],
    [("e", [[(M2, True)], [(M1, True), (CVC, False)]], "")],
    [("l", [[(M2, True), ("l$", True)]], "")],
]


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a word of three or more letters a-z; others stay."""
    if not re.fullmatch("[a-z]{3,}", word):
        return word
    w = re.sub("([aeiouy])y", r"\1Y", re.sub("^y", "Y", word))
    for step in STEPS:
        for suffix, condition, new, *otherwise in step:
            if w.endswith(suffix):
                head = w[:len(w) - len(suffix)]
                ok = any(all(bool(re.search(p, head)) == found for p, found in alternative) for alternative in condition)
                w = head + (new if ok else otherwise[0] if otherwise else suffix)
                break
    return w.lower()


def sql_stem(word: str) -> str:
    """The same as a DuckDB expression of the SQL expression ``word``."""
    w = f"regexp_replace(regexp_replace({word}, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g')"
    for step in STEPS:
        cases = []
        for suffix, condition, new, *otherwise in step:
            head = f"w[:len(w) - {len(suffix)}]"
            ok = " OR ".join("(" + (" AND ".join(f"{'' if found else 'NOT '}regexp_matches({head}, '{p}')" for p, found in a) or "true") + ")"
                             for a in condition)
            cases.append(f"WHEN ends_with(w, '{suffix}') THEN {head} || CASE WHEN {ok} THEN '{new}' ELSE '{otherwise[0] if otherwise else suffix}' END")
        w = f"list_transform([{w}], lambda w: CASE {' '.join(cases)} ELSE w END)[1]"
    return f"CASE WHEN regexp_full_match({word}, '[a-z]{{3,}}') THEN lower({w}) ELSE {word} END"


def stem_tokens(tokens: Column, longer_than: int = 0) -> Column:
    """The stems of a token array; tokens of at most ``longer_than``
    characters stay.  A batch stems its distinct tokens only."""
    @F.arrow_udf("array<string>")
    def stems(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().dictionary_encode()
        new = [stem(t) if len(t) > longer_than else t for t in flat.dictionary.to_pylist()]
        size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(new, pa.string()).take(flat.indices))

    return stems(tokens)
