"""Date, entity and attribute dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, month_spine
from .aggregates import distinct_on, min_max_across
from .joins import Keys, as_list
from .ordering import order
from .rows import valid_key


def date_dim(tables: Sequence[DataFrame], col: str = "report_month") -> DataFrame:
    """One row per month from the first to the last month of any table, gaps included."""
    return month_spine(min_max_across(tables, col), "low", "high", col).withColumns(calendar_columns(col))


def attribute_dim(fact: DataFrame, code: str, name: str) -> DataFrame:
    """Distinct (code, name) with a valid code, sorted by name."""
    return order(valid_key(distinct_on(fact, [code, name]), code), name, code)


def _sort_key(columns: Sequence[Column]) -> Column:
    """A comparable struct that puts missing values last."""
    return F.struct(*[part for c in columns for part in (c.isNull(), c)])


def first_last_non_null(
    df: DataFrame,
    key: Keys,
    order_by: Sequence[str],
    *,
    first: Sequence[str] = (),
    last: Sequence[str] = (),
) -> DataFrame:
    """First / last non-missing value of columns per key, in the order of ``order_by`` (missing last)."""
    place = _sort_key([F.col(c) for c in order_by])
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in first]
    picks += [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in last]
    return df.groupBy(*as_list(key)).agg(*picks)


def entity_dim(
    history: DataFrame,
    key: str,
    *,
    source: str,
    period: str,
    last: Sequence[str] = (),
    first: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key from its stacked history: first / last known attributes and presence flags.

    History is ordered by (``source``, ``period``, ``tie_break``...): later sources win over newer
    periods of earlier ones. Rows that differ only in their period are first collapsed to the
    earliest and latest one, with a plain min / max that combines inside each task; what remains to
    be ordered is one row per version of an entity, not its whole history.
    """
    flags = dict(flags or {})
    versions = list(dict.fromkeys([key, source, *tie_break, *first, *last]))
    spans = (
        valid_key(history, key)
        .groupBy(*versions)
        .agg(
            F.min(period).alias("__from"),
            F.max(period).alias("__to"),
            F.bool_or(F.col(period).isNull()).alias("__open"),
            *[F.bool_or(c).alias(n) for n, c in flags.items()],
        )
    )
    rest = [F.col(c) for c in dict.fromkeys([*tie_break, *first, *last])]
    earliest = F.struct(F.col(source), _sort_key([F.col("__from"), *rest]))
    latest = F.struct(F.col(source), _sort_key([F.when(~F.col("__open"), F.col("__to")), *rest]))
    picks = {c: F.max_by(c, F.when(F.col(c).isNotNull(), latest)) for c in last}
    picks.update({c: F.min_by(c, F.when(F.col(c).isNotNull(), earliest)) for c in first})
    return spans.groupBy(key).agg(
        *[picks[c].alias(c) for c in picks], *[F.bool_or(n).alias(n) for n in flags]
    )
