"""Column expressions for text: whitespace, tokenizers, n-grams, numbers.

All of these are built-in Spark expressions (JVM side, whole-stage
codegen), usable on batch and streaming DataFrames alike.

Java's ``\\s`` and ``trim`` are ASCII-only while Python's ``str.strip`` /
``str.split`` are Unicode-aware, so whitespace is an explicit class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split()/str.strip() treat as
# whitespace, written as one regex class (valid in Java regex and RE2).
WS = (r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# Word characters as Python's Unicode ``\w``: letters, numbers, underscore.
WORD = r"[\p{L}\p{N}_]"

# A "numeric" answer word: digits with at most one dot and at least one
# digit (``s.replace('.', '', 1).isdigit()``), ASCII digits.
NUMERIC = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col_(c), f"^{WS}+|{WS}+$", "")


def py_split(c: str | Column) -> Column:
    """``str.split()`` with no argument: whitespace runs, no empty items."""
    s = py_strip(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, f"{WS}+"))


def word_tokens(c: str | Column) -> Column:
    """T1 default tokenizer: lower-cased runs of word characters."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(f"({WORD}+)"), 1)


def vectorizer_tokens(c: str | Column) -> Column:
    """F1 tokenizer: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(f"({WORD}{{2,}})"), 1)


def rouge_tokens(c: str | Column) -> Column:
    """ROUGE tokenizer: lower case, ASCII letters and digits only."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit("([a-z0-9]+)"), 1)


def meteor_tokens(c: str | Column) -> Column:
    """METEOR tokenizer: lower-cased words, each other symbol its own token."""
    ws_body = WS[1:-1]
    return F.regexp_extract_all(F.lower(col_(c)),
                                F.lit(f"({WORD}+|[^\\p{{L}}\\p{{N}}_{ws_body}])"), 1)


def ter_tokens(c: str | Column) -> Column:
    """TER / WER tokenizer: lower case, whitespace split."""
    return py_split(F.lower(col_(c)))


# The 13a BLEU tokenizer's rules (public sacreBLEU behaviour):
# punctuation class, period/comma unless next to a digit, dash after a digit.
_13A_PUNCT = r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"
_13A_RULES = (
    (_13A_PUNCT, " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def bleu_tokens(c: str | Column) -> Column:
    """13a tokenization as used by corpus BLEU."""
    s = F.replace(col_(c), F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in _13A_RULES:
        s = F.regexp_replace(s, pat, rep)
    return py_split(s)


def ngram_strings(tokens: Column, n: int | Column) -> Column:
    """Word n-grams of a token array, joined by a space (empty if too short)."""
    if isinstance(n, int):
        if n == 1:
            return tokens
        n = F.lit(n)
    return F.when(
        F.size(tokens) >= n,
        F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                    lambda i: F.array_join(F.slice(tokens, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def char_ngrams(chars: Column, n: Column) -> Column:
    """Character n-grams of an array of characters (``characters``)."""
    return F.when(
        F.size(chars) >= n,
        F.transform(F.sequence(F.lit(1), F.size(chars) - n + 1),
                    lambda i: F.array_join(F.slice(chars, i, n), "")),
    ).otherwise(F.array().cast("array<string>"))


def characters(text: Column) -> Column:
    """The code points of a string, split once: cutting n-grams from the
    array takes time in proportion, cutting them from the string would
    scan it anew for each position."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def is_numeric(c: Column) -> Column:
    return c.rlike(NUMERIC)
