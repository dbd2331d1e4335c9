"""Corpus pipeline: raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on everything its
predecessor kept and is written to Parquet and read again before the
next one.  ``run`` applies them to ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.llm.common import load
from tessera.session import ensure_checkpoint_dir

STAGES = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("substrings", stages.substrings),
    ("mix", stages.mix),
    ("encode", stages.encode),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are
    written to the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
