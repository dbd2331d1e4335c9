"""Named-split datasets.

A dataset with named splits is one DataFrame with a ``split`` column (on
disk: a Parquet/JSON folder partitioned by ``split``, so selecting a
split prunes partitions instead of scanning the others).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_names(df: DataFrame, split_col: str = "split", candidates=None) -> set[str]:
    """Which of ``candidates`` exist: one job, answered from the folder
    names where the dataset is partitioned by split."""
    names = list(candidates or ("train", "validation", "test"))
    return {r[0] for r in df.select(split_col).filter(F.col(split_col).isin(names)).distinct().collect()}


def load_split(df: DataFrame, required: list[str], split_col: str = "split") -> DataFrame:
    """The rows of the ``required`` splits; raise if any is absent."""
    missing = [n for n in required if n not in split_names(df, split_col, required)]
    if missing:
        raise ValueError(f"split(s) not found: {missing}")
    return df.filter(F.col(split_col).isin(*required))


def read_split_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                       required: list[str] | None = None, schema=None) -> DataFrame:
    """Read a split-partitioned folder; ``required`` splits must be present."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return load_split(df, required) if required else df


def write_split_dataset(df: DataFrame, path: str, fmt: str = "parquet",
                        split_col: str = "split", mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(split_col).format(fmt).save(path)
