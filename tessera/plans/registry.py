"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables.  Keys without SQL are checked by row count in the driver
and by golden tests here (dynamic programs, MLlib, Python model calls).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Round a double to 6 places: the precision results are compared at.

    ``floor(x * 1e6 + 0.5) / 1e6`` is plain IEEE arithmetic, so equal
    doubles round equally in every engine (``round`` implementations
    differ on ties).  The oracle SQL uses the same formula (``R6``).
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(x) == F.lit(float("inf")), x).otherwise(F.floor(x * 1e6 + 0.5) / 1e6)


def R6(x: str) -> str:
    """SQL twin of ``r6``."""
    return f"(floor(({x}) * 1e6 + 0.5) / 1e6)"
