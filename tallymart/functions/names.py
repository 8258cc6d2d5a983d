"""Column-name work. It runs on the driver over ``df.columns``, never over data."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Signs spelled out or dropped before a name is split into words.
SIGN_WORDS = {"'": "", '"': "", "%": "_percent_", "#": "_number_"}

KINDS = {
    "numeric": (T.NumericType,),
    "character": (T.StringType,),
    "date": (T.DateType,),
    "logical": (T.BooleanType,),
}


def clean_name(name: str) -> str:
    """``Gt 00 To 01 Weeks SUM 1`` -> ``gt_00_to_01_weeks_sum_1``."""
    for sign, word in SIGN_WORDS.items():
        name = name.replace(sign, word)
    name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    name = re.sub(r"([a-z0-9])([A-Z])|([A-Z])([A-Z][a-z])", r"\1\3_\2\4", name)
    name = re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_").lower()
    if not name or name[0].isdigit():
        name = "x" + name
    return name


def unique_clean_names(names: Iterable[str]) -> list[str]:
    """Cleaned names, with ``_2``, ``_3`` ... on repeats."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for name in map(clean_name, names):
        seen[name] = seen.get(name, 0) + 1
        candidate = name if seen[name] == 1 else f"{name}_{seen[name]}"
        while candidate in out:
            seen[name] += 1
            candidate = f"{name}_{seen[name]}"
        out.append(candidate)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to its cleaned name."""
    return df.toDF(*unique_clean_names(df.columns))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric``, ``character``, ``date`` or ``logical`` columns, in order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def columns_matching(df_or_names: DataFrame | Sequence[str], pattern: str, *, ignore_case: bool = True) -> list[str]:
    """Names that contain a match of ``pattern``, in order."""
    names = df_or_names.columns if isinstance(df_or_names, DataFrame) else df_or_names
    regex = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return [n for n in names if regex.search(n)]


def likely_fields(df_or_names: DataFrame | Sequence[str], patterns: Mapping[str, str]) -> dict[str, list[str]]:
    """Columns that look like each kind of field, by name, whatever the letter case."""
    return {kind: columns_matching(df_or_names, pattern) for kind, pattern in patterns.items()}


def columns_except(df: DataFrame, *excluded: str) -> list[str]:
    """All names but ``excluded``, in order."""
    return [n for n in df.columns if n not in excluded]


def band_lookup(names: DataFrame | Sequence[str], pattern: str) -> dict[str, int]:
    """Band columns and where each starts: ``pattern`` must capture the start as its first group."""
    names = names.columns if isinstance(names, DataFrame) else names
    found = ((n, re.search(pattern, n)) for n in names)
    return {n: int(m.group(1)) for n, m in found if m}
