"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import as_col, quoted
from ..functions.names import columns_of_type


def text_equals(col, label: str) -> Column:
    """Case-insensitive equality with a label."""
    return F.upper(as_col(col)) == label.upper()


def drop_totals(df: DataFrame, col: str, label: str = "TOTAL", keep: bool = False) -> DataFrame:
    """Drop published aggregate rows, or keep only them. Rows with a missing value go either way."""
    is_total = text_equals(col, label)
    return df.filter(is_total if keep else ~is_total)


def any_text_equals(df: DataFrame, label: str = "TOTAL") -> DataFrame:
    """Rows in which any text column equals the label."""
    tests = [text_equals(quoted(c), label) for c in columns_of_type(df, "character")]
    return df.filter(reduce(or_, tests, F.lit(False)))


def valid_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither missing nor empty."""
    return df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
