"""The stages of the corpus pipeline: each calls one operator of this
subpackage on everything its predecessor kept.  All but the last return
the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import anchors, bpe, fm, mixing, simhash
from tessera.llm.common import held_out, load
from tessera.llm.queries import QUALITY_SAMPLE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine (fitted on ``labels``)
    scores 0.7 or more."""
    sample = fm.labelled_sample(docs, load(spark, sf_dir, "labels"), "quality", lambda c: ~held_out(c), QUALITY_SAMPLE)
    scored = fm.score(docs, fm.fit(sample), COLUMNS, out="quality_score")
    return scored.where("quality_score >= 0.7").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (four-word
    shingles, four bits): the one with the smallest id.  Rows that repeat
    an id count as one only within a group; rows without an id stay."""
    return simhash.without_near_duplicates(docs, COLUMNS, shingle=4, radius=4)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that a document with
    a smaller id holds; what loses a passage is joined by single spaces,
    and documents that lose every word go."""
    rest = [c for c in COLUMNS if c != "text"]
    out = anchors.substring_dedup(docs, rest, verbatim=True).where("n_removed = 0 or n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it: at most twice.  The
    null source is one of its own; null and empty texts have no words and
    are drawn like the others of their source; rows that repeat are drawn
    each by itself, and a rerun draws the same; no rows give none."""
    mixed = mixing.mix_sources(docs, COLUMNS).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of the bytes they decode to;
    null and empty texts have no ids and decode to no bytes.  Every row
    stays, also without an id or repeated; no rows give none."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs.select("doc_id", "source", "text"), path, pattern, decoded="decoded")
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
