"""Parquet table access.

Every reader selects only the columns the caller names, so the scan's
``ReadSchema`` carries just those columns and filters written on top are
pushed into the Parquet reader by Catalyst.  Rows are left in the splits
of the scan: an operator that needs them clustered does so itself, by a
key that cannot be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"table {name} lacks columns {missing}")
        df = df.select(*columns)
    return df
