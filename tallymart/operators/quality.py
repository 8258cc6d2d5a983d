"""Checks: keys, ranges and totals. Each check is a small DataFrame; ``qa_summary`` unions them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import as_col
from ..functions.names import columns_of_type
from ..functions.rowwise import as_exact, row_sum, sum_type
from .aggregates import count_by, distinct_on, rollup_measures, sanity_counts, sum_all_numeric
from .joins import Keys, as_list, join_on, missing_keys
from .reshape import stack, wide_to_long


def duplicate_keys(df: DataFrame, keys: Keys, name: str = "n") -> DataFrame:
    """Keys that occur more than once, with how often."""
    return count_by(df, keys, name).filter(F.col(name) > 1)


def conflicting_attributes(df: DataFrame, key: Keys, attribute: str, name: str = "name_count") -> DataFrame:
    """Keys that carry more than one value of ``attribute``; a missing value counts as one."""
    keys = as_list(key)
    return duplicate_keys(distinct_on(df, [*keys, attribute]), keys, name)


def issue_count(check: str, issues: DataFrame, weight: str | None = None) -> DataFrame:
    """(check, issue_count): rows of a check result, or the sum of ``weight`` over them."""
    n = F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))
    return issues.agg(n.cast("bigint").alias("issue_count")).select(F.lit(check).alias("check"), "issue_count")


def unique_key_check(check: str, df: DataFrame, keys: Keys) -> DataFrame:
    """(check, issue_count): keys that are not unique."""
    return issue_count(check, duplicate_keys(df, keys))


def foreign_key_check(
    check: str,
    fact: DataFrame,
    dim: DataFrame,
    on: Keys,
    right_on: Keys | None = None,
    null_safe: bool = True,
    unique: bool = True,
) -> DataFrame:
    """(check, issue_count): fact rows whose key is absent from the dimension.

    The fact is reduced to its distinct keys and their row counts before it meets the dimension, so
    the join input is as small as the key set however often a key occurs. ``unique`` as in
    ``missing_keys``.
    """
    absent = missing_keys(count_by(fact, on, "__n"), dim, on, right_on, null_safe, unique)
    return issue_count(check, absent, "__n")


def grain_checks(
    fact: DataFrame,
    keys: Keys,
    unique: str | None = None,
    references: Mapping[str, tuple[DataFrame, Keys, Keys]] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(check, issue_count) of all checks of one fact, from one scan of it.

    The fact is reduced to its grain: how many rows have each key, and how many of them meet each rule. From that
    follow ``unique``, the keys that are not unique, ``references`` (check to dimension, own keys, its keys), the
    fact rows whose key is absent from the dimension (null matches null), and ``rules``, the rows that meet one.
    """
    keys, references, rules = as_list(keys), references or {}, rules or {}
    met = [F.count_if(rule).alias(f"__rule_{i}") for i, rule in enumerate(rules.values())]
    grain = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *met)
    counts = {unique: F.count_if(F.col("__n") > 1)} if unique else {}
    for i, (check, (dim, on, right_on)) in enumerate(references.items()):
        found = f"__found_{i}"
        known = dim.select(*[F.col(r).alias(k) for k, r in zip(as_list(on), as_list(right_on))]).distinct()
        grain = join_on(grain, known.withColumn(found, F.lit(True)), on)
        counts[check] = F.sum(F.when(F.col(found).isNull(), F.col("__n")))
    for i, check in enumerate(rules):
        counts[check] = F.sum(f"__rule_{i}")
    one = grain.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(check) for check, c in counts.items()])
    return wide_to_long(one, "check", "issue_count")


def range_check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(check, issue_count) per rule: rows that meet it. All rules share one pass."""
    return wide_to_long(sanity_counts(df, rules, rows=None), "check", "issue_count")


def band_reconciliation(df: DataFrame, parts: Sequence[str], total: str, ranges: Sequence[str] = ()) -> DataFrame:
    """One row: rows, rows whose parts add up to the total, rows whose parts do not, min / max of ``ranges``. Doubles
    add up as the decimals they are written as."""
    df = as_exact(df, [c for c in dict.fromkeys([*parts, total]) if c not in ranges])
    parts_sum = row_sum(parts, nulls="propagate")
    return sanity_counts(
        df,
        {"total_matches": parts_sum == F.col(total), "total_mismatches": parts_sum != F.col(total)},
        ranges,
    )


def published_total_check(rows: DataFrame, totals: DataFrame, file: Keys, dtype: str | None = None) -> DataFrame:
    """Sums of every numeric column per file against the published total rows, one row per metric.

    Gives the file, metric, calculated_total, published_total, difference and matches; a metric with
    no published value has a missing outcome. ``dtype`` is the type of both sides; by default the one in
    which the metrics add up without loss. Doubles add up as the decimals they are written as, so the outcome does
    not change with the order of rows.
    """
    files = as_list(file)
    metrics = [c for c in columns_of_type(rows, "numeric") if c not in files]
    rough = not dtype and sum_type(rows.select(*metrics).unionByName(totals.select(*metrics)), metrics) == "double"
    rows, totals = as_exact(rows, metrics), as_exact(totals, metrics)
    calculated = sum_all_numeric(rows, files)
    dtype = dtype or sum_type(calculated.select(*metrics).unionByName(totals.select(*metrics)), metrics)
    calculated = wide_to_long(calculated, "metric", "calculated_total", files, dtype)
    published = wide_to_long(totals.select(*files, *metrics), "metric", "published_total", files, dtype)
    difference = F.col("calculated_total") - F.col("published_total")
    checked = join_on(calculated, published, [*files, "metric"]).withColumns(
        {"difference": difference, "matches": difference == 0}
    )
    shown = ("calculated_total", "published_total", "difference")
    return checked.withColumns({c: F.col(c).cast("double") for c in shown}) if rough else checked


def grain_reconciliation(
    coarse: DataFrame, fine: DataFrame, keys: Keys, measures: Sequence[str], fine_name: str = "fine_{}"
) -> DataFrame:
    """Each coarse fact row against the finer fact summed to its keys: measures, fine sums, differences."""
    keys = as_list(keys)
    names = {m: fine_name.format(m) for m in measures}
    both = join_on(coarse.select(*keys, *measures), rollup_measures(fine, keys, names), keys)
    return both.withColumns({f"{m}_difference": F.col(m) - F.col(n) for m, n in names.items()})


def reconciliation_summary(
    diffs: DataFrame,
    col: str,
    rows: str = "rows",
    matches: str = "exact_matches",
    mismatches: str = "mismatches",
    largest: str = "max_absolute_difference",
    unmatched: str | None = None,
) -> DataFrame:
    """One row: rows, exact matches, mismatches and largest absolute difference.

    A missing difference is neither match nor mismatch; ``unmatched`` names a column to count it in.
    """
    d = as_col(col)
    aggregates = [
        F.count(F.lit(1)).alias(rows),
        F.count_if(d == 0).alias(matches),
        F.count_if(d != 0).alias(mismatches),
        F.max(F.abs(d)).alias(largest),
    ]
    if unmatched:
        aggregates.append(F.count_if(d.isNull()).alias(unmatched))
    return diffs.agg(*aggregates)


def qa_summary(checks: Sequence[DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """(check, issue_count, status): all checks in one frame, PASS where nothing was found, else REVIEW.

    ``names`` fixes the row order.
    """
    out = stack(*checks).withColumn("status", F.when(F.col("issue_count") == 0, "PASS").otherwise("REVIEW"))
    if names:
        place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("check"))
        out = out.orderBy(place)
    return out
