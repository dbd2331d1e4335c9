"""Text features: term counts, n-grams, IDF, TF-IDF.

Features stay sparse in long form ``(doc, term, weight)``; nothing is
densified.  Term counting clusters by document once (``cluster``), so
``groupBy(doc, term)`` runs without a further exchange; the IDF join goes
broadcast when AQE measures the IDF table small, else sort-merge with
AQE skew splitting for stop words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import ngram_strings, vectorizer_tokens
from tessera.plans.ranking import cluster, global_rank


def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """Array column ``terms``: the document's tokens and word n-grams.

    Tokens are materialized as a column first: n-gram lambdas then read
    the array instead of re-running the tokenizer per position.
    """
    toks = docs.select(id_col, vectorizer_tokens(text_col).alias("_toks"))
    lo, hi = ngram_range
    grams = [ngram_strings(F.col("_toks"), n) for n in range(lo, hi + 1)]
    terms = grams[0] if len(grams) == 1 else F.concat(*grams)
    return toks.select(id_col, terms.alias("terms"))


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(id, term, tf)`` raw counts per document.

    ``explode_outer`` + a null filter keeps Catalyst from inferring a
    ``size(terms) > 0`` filter below the exchange, which would tokenize
    every text twice.
    """
    d = cluster(docs.select(id_col, text_col), id_col)
    ex = doc_terms(d, id_col, text_col, ngram_range).select(
        id_col, F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    return ex.groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def idf_fit(train_counts: DataFrame, n_docs, id_col: str = "doc_id",
            vocabulary: DataFrame | None = None) -> DataFrame:
    """smooth IDF ``ln((1 + N) / (1 + df)) + 1`` per term on the train split.

    ``n_docs`` is the number of train documents (a Column scalar or int),
    counting documents without any token.
    """
    df_ = train_counts.groupBy("term").agg(F.count("*").alias("df"))
    if vocabulary is not None:
        df_ = df_.join(vocabulary.select("term"), "term")
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return df_.select("term", "df",
                      (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def topk_terms(train_counts: DataFrame, k: int | None) -> DataFrame:
    """``max_features``: top-k terms by corpus count, ties by term.

    The row limit is the feature here (k is a user bound); None keeps all.
    """
    totals = train_counts.groupBy("term").agg(F.sum("tf").alias("corpus_count"))
    if k is None:
        return totals
    return totals.orderBy(F.desc("corpus_count"), "term").limit(k)


def column_ids(terms: DataFrame, max_features: int | None = None) -> DataFrame:
    """``(term, column)``: columns in alphabetical order from 0.

    A vocabulary cut to ``max_features`` (a user bound on its rows) is
    numbered by a window; without the bound by a distributed rank."""
    if max_features is None:
        ranked = global_rank(terms.select("term"), ["term"], rank_col="column")
        return ranked.select("term", F.col("column").cast("int").alias("column"))
    return terms.select("term", (F.row_number().over(Window.orderBy("term")) - 1).cast("int").alias("column"))


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``tf * idf`` L2-normalized per document; unseen terms dropped."""
    j = counts.join(idf.select("term", "idf"), "term")
    w = F.col("tf") * F.col("idf")
    by_doc = Window.partitionBy(id_col)
    return j.select(id_col, "term", w.alias("w")).select(
        id_col, "term", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(by_doc))).alias("x"))
