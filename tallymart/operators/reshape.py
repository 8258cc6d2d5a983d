"""Wide to long, and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted


def stack(*dfs: DataFrame) -> DataFrame:
    """Union all of same-shaped tables, matched by column name."""
    return reduce(DataFrame.unionByName, dfs)


def wide_to_long(df: DataFrame, name: str, value: str, ids: Sequence[str] = (), dtype: str | None = None) -> DataFrame:
    """One row per (id, column). Missing values are kept. ``dtype`` first casts the value columns."""
    columns = [c for c in df.columns if c not in ids]
    if dtype:
        df = df.select(*[quoted(c) for c in ids], *[quoted(c).cast(dtype).alias(c) for c in columns])
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in columns], name, value)


def stats_to_long(
    df: DataFrame, columns: Sequence[str], stats: Mapping[str, object], name: str = "metric"
) -> DataFrame:
    """(metric, stat...) from one wide summary row, one struct of statistics per column.

    ``stats`` maps an output name to a function from a column to an aggregate. The statistics of
    all columns must share types. For many columns ``numeric_profile`` compiles faster.
    """

    def summary(c: str) -> Column:
        return F.struct(*[make(quoted(c)).alias(s) for s, make in stats.items()]).alias(c)

    wide = df.agg(*[summary(c) for c in columns])
    return wide_to_long(wide, name, "__stats").select(name, "__stats.*")
