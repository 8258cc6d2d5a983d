"""Grouped and whole-table aggregates.

All of them combine inside each task before shuffling, so a key that holds much of the data
costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import as_col, quoted
from ..functions.names import columns_of_type
from ..functions.rowwise import safe_ratio
from .joins import Keys, as_list
from .ordering import order
from .reshape import stack


def total(col) -> Column:
    """Sum that skips missing values and is 0 when there are none."""
    return F.coalesce(F.sum(as_col(col)), F.lit(0))


def count_by(df: DataFrame, keys: Keys, name: str = "n", sort: bool = False) -> DataFrame:
    """Rows per key; ``sort`` puts the largest first and breaks ties by key."""
    keys = as_list(keys)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return order(out, f"-{name}", *keys) if sort else out


def rows_and_distinct(df: DataFrame, group: Keys, col: str, rows: str = "rows", distinct: str | None = None) -> DataFrame:
    """Row count and number of distinct values of ``col`` per group.

    Counting per (group, value) first spreads a large group over its values.
    """
    group = as_list(group)
    pairs = df.groupBy(*group, col).agg(F.count(F.lit(1)).alias("__n"))
    return pairs.groupBy(*group).agg(
        F.sum("__n").alias(rows), F.count(F.lit(1)).alias(distinct or f"distinct_{col}")
    )


def distinct_on(df: DataFrame, cols: Keys) -> DataFrame:
    """Distinct rows on the chosen columns."""
    return df.select(*as_list(cols)).distinct()


def sum_all_numeric(df: DataFrame, key: Keys) -> DataFrame:
    """Sum of every numeric column per key."""
    keys = as_list(key)
    columns = [c for c in columns_of_type(df, "numeric") if c not in keys]
    return df.groupBy(*keys).agg(*[total(quoted(c)).alias(c) for c in columns])


def build_fact(
    df: DataFrame, keys: Keys, measures: Sequence[str], ratio: tuple[str, str, str] | None = None
) -> DataFrame:
    """Sum measures to a coarser grain; ``ratio`` is (numerator, denominator, name), taken after the sums."""
    fact = df.groupBy(*as_list(keys)).agg(*[total(m).alias(m) for m in measures])
    return fact.withColumn(ratio[2], safe_ratio(ratio[0], ratio[1])) if ratio else fact


def rollup_measures(fact: DataFrame, keys: Keys, measures: Mapping[str, str]) -> DataFrame:
    """Re-aggregate a finer fact; ``measures`` maps measure to output name."""
    return fact.groupBy(*as_list(keys)).agg(*[total(m).alias(name) for m, name in measures.items()])


def non_missing_sums(df: DataFrame, keys: Keys, col: str) -> DataFrame:
    """Rows, non-missing values and sum of ``col`` per key."""
    return df.groupBy(*as_list(keys)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(col)).alias(f"non_missing_{col}"),
        total(col).alias(f"{col}_sum"),
    )


def sanity_counts(
    df: DataFrame, predicates: Mapping[str, Column], ranges: Sequence[str] = (), rows: str | None = "rows"
) -> DataFrame:
    """One row: how many rows meet each predicate (missing is not met), and min / max of ``ranges``."""
    aggregates = [F.count(F.lit(1)).alias(rows)] if rows else []
    aggregates += [F.count_if(p).alias(n) for n, p in predicates.items()]
    for c in ranges:
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggregates)


def min_max_across(tables: Sequence[DataFrame], col: str, low: str = "low", high: str = "high") -> DataFrame:
    """One row: smallest and largest value of a column over several tables.

    Each table is reduced to one row before the tables meet.
    """
    bounds = [t.agg(F.min(col).alias(low), F.max(col).alias(high)) for t in tables]
    return stack(*bounds).agg(F.min(low).alias(low), F.max(high).alias(high))


def any_true(df: DataFrame, key: Keys, flags: Mapping[str, Column]) -> DataFrame:
    """Per key, whether each condition holds for any row."""
    return df.groupBy(*as_list(key)).agg(*[F.bool_or(c).alias(n) for n, c in flags.items()])


def dataset_overview(df: DataFrame, file_col: str) -> DataFrame:
    """One row: total rows, columns and source files."""
    return (
        df.groupBy(file_col)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            total("__n").cast("bigint").alias("total_rows"),
            F.lit(len(df.columns)).alias("total_columns"),
            F.count(F.lit(1)).alias("source_files"),
        )
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of named tables."""
    return stack(
        *[t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()]
    )


def match_tally(df: DataFrame, col: str = "matches") -> DataFrame:
    """Rows per value of a comparison; a missing outcome is its own group."""
    return count_by(df, col)


def status_tally(qa: DataFrame, status: str = "status") -> DataFrame:
    """One row: checks, how many pass, how many need review, and whether all pass."""
    passed = F.col(status) == "PASS"
    return qa.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(passed).alias("passed"),
        F.count_if(~passed).alias("review"),
        F.bool_and(passed).alias("all_passed"),
    )

