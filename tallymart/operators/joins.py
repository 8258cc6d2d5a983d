"""Equi-joins in which a missing key matches a missing key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _with_hidden_keys(right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    hidden = [f"__key_{i}" for i in range(len(keys))]
    rest = [quoted(c) for c in right.columns if c not in keys]
    return right.select(*[quoted(k).alias(h) for k, h in zip(keys, hidden)], *rest), hidden


def _condition(left_on: Sequence[str], hidden: Sequence[str], null_safe: bool):
    pairs = [(F.col(k), F.col(h)) for k, h in zip(left_on, hidden)]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def join_on(left: DataFrame, right: DataFrame, on: Keys, how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on same-named keys and keep the left keys only. Spark chooses the join strategy by size."""
    keys = as_list(on)
    right, hidden = _with_hidden_keys(right, keys)
    return left.join(right, _condition(keys, hidden, null_safe), how).drop(*hidden)


def missing_keys(
    fact: DataFrame,
    dim: DataFrame,
    on: Keys,
    right_on: Keys | None = None,
    null_safe: bool = True,
    unique: bool = True,
) -> DataFrame:
    """Rows of ``fact`` whose key is absent from ``dim``; the keys may be named differently.

    A dimension holds each key once. For a table that repeats keys pass ``unique=False``: its keys
    are then made distinct first, so that a hot one does not meet the join as often as it occurs.
    """
    left_on, dim_on = as_list(on), as_list(right_on or on)
    keys = dim.select(*[quoted(k) for k in dim_on])
    right, hidden = _with_hidden_keys(keys if unique else keys.distinct(), dim_on)
    return fact.join(right, _condition(left_on, hidden, null_safe), "left_anti")
