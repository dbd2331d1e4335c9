"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package
from tessera.sources.tables import table_path

#: ASCII white space separates words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The whole table as Spark reads it."""
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, table))


def n_words(text: Column) -> Column:
    """Words of the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names: whatever else the frame
    holds, also under clashing names, stays out of the operator."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared checkpoint folder: what follows
    reads that table again, also after executors are lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
