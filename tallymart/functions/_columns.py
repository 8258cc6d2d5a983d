from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(value) if isinstance(value, str) else value


def quoted(name: str) -> Column:
    """The column called exactly ``name``, even if it holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")
