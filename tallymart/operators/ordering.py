"""Ordering with missing values last in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order(df: DataFrame, *keys: str) -> DataFrame:
    """Sort by ``keys``; a leading ``-`` means descending. Missing values come last either way."""
    return df.orderBy(*[F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys])


def first_n(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows in the given order; each task keeps only its own best ``n``."""
    return order(df, *keys).limit(n)
