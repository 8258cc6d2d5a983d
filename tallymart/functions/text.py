"""Text expressions. All stay JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_col


def strip_prefix(col, prefix: str, *, regex: bool = False) -> Column:
    """Remove ``prefix`` from the start of the text, if it is there."""
    pattern = prefix if regex else re.escape(prefix)
    return F.regexp_replace(as_col(col), f"^(?:{pattern})", "")


def missing_text(col, markers: tuple[str, ...] = ("", "NA")) -> Column:
    """Trim the text and turn blank cells and missing-value markers into null."""
    trimmed = F.trim(as_col(col))
    return F.when(~trimmed.isin(*markers), trimmed)


def base_name(col) -> Column:
    """Last component of a ``/``-separated path."""
    return F.element_at(F.split(as_col(col), "/"), -1)


def plain_path(col) -> Column:
    """A path or file name without the percent signs that ``_metadata`` columns carry."""
    c = as_col(col)
    return F.when(c.contains("%"), F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)
