"""Row arithmetic: null-ignoring and null-propagating sums, guarded ratios, banded thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._columns import as_col


def safe_ratio(num, den) -> Column:
    """``num / den`` where the denominator is above zero, else null."""
    n, d = as_col(num).cast("double"), as_col(den).cast("double")
    return F.when(d > 0, n / d)


def sum_type(df: DataFrame, cols: Sequence[str]) -> str:
    """The type in which columns add up without loss: bigint if all are whole, decimal with the longest
    fraction if all others are decimal, else double. Text adds up as bigint, where a fraction is an error."""
    kinds = [df.schema[c].dataType for c in cols]
    if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
        return "double"
    scales = [k.scale for k in kinds if isinstance(k, T.DecimalType)]
    return f"decimal(38,{max(scales)})" if scales else "bigint"


# Doubles that are to add up without regard to order are read as decimals with so many digits behind the point.
EXACT = "decimal(38,10)"


def as_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with the float and double columns of ``cols`` as the decimals they are written as, so that 0.1 + 0.2 is 0.3
    in any order. A value without such a decimal (NaN, infinite, 10^28 and more) stops the job."""
    out = {}
    for c in cols:
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            number = F.col(c).cast("string").try_cast(EXACT)
            message = F.concat(F.lit(f"no exact sum of column {c} with "), F.col(c).cast("string"))
            out[c] = F.when(F.col(c).isNull() | number.isNotNull(), number).otherwise(F.raise_error(message).cast(EXACT))
    return df.withColumns(out) if out else df


def row_sum(cols: Sequence, nulls: str = "ignore", dtype: str | None = None) -> Column:
    """Sum of several columns of one row.

    ``nulls="ignore"`` skips missing cells, so an all-missing row gives 0;
    ``nulls="propagate"`` makes one missing cell turn the sum missing.
    The columns add up in their own types, whole ones as bigint; no fraction is cut. ``dtype``, best from
    ``sum_type``, casts them first and keeps the code of long sums small.
    """
    if nulls not in ("ignore", "propagate"):
        raise ValueError(f"nulls must be 'ignore' or 'propagate', not {nulls!r}")
    zero = F.lit(0).cast(dtype or "bigint")
    terms = [as_col(c).cast(dtype) if dtype else as_col(c) for c in cols]
    if nulls == "propagate":
        return reduce(add, terms, zero)
    if not dtype:
        return reduce(add, [F.coalesce(t, zero) for t in terms], zero)
    if not terms:
        return zero
    # An array fold keeps the generated code small however many columns are summed.
    return F.aggregate(F.array_compact(F.array(*terms)), zero, lambda total, x: total + x)


def with_measures(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Add columns one after the other, so that later ones may use earlier ones."""
    return reduce(lambda acc, item: acc.withColumn(*item), measures.items(), df)


def band_thresholds(
    df: DataFrame,
    bands: Mapping[str, int],
    cuts: Sequence[int],
    *,
    within: str = "within_{}_weeks",
    over: str = "over_{}_weeks",
) -> DataFrame:
    """Sum band columns below the first cut, and at or above each cut.

    The thresholds nest, so each band is read once into the segment between two cuts
    and the few segment sums are added up, instead of one long sum per threshold.
    """
    cuts = sorted(cuts)
    edges = [None, *cuts, None]
    segments = []
    for low, high in zip(edges[:-1], edges[1:]):
        segments.append(
            [c for c, start in bands.items() if (low is None or start >= low) and (high is None or start < high)]
        )
    names = [f"__segment_{i}" for i in range(len(segments))]
    dtype = sum_type(df, list(bands))
    summed = df.withColumns({n: row_sum(cols, dtype=dtype) for n, cols in zip(names, segments)})
    out = {within.format(cuts[0]): F.col(names[0])}
    for i, cut in enumerate(cuts, start=1):
        out[over.format(cut)] = reduce(add, [F.col(n) for n in names[i:]])
    return summed.withColumns(out).drop(*names)
