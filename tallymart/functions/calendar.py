"""Month parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._columns import as_col
from .text import strip_prefix

# Two-digit years by century, and spellings of "month year" once separators are blanks.
TWO_DIGIT_YEARS = {r"[0-5]\d|6[0-8]": "20", r"69|[7-9]\d": "19"}
LONG_MONTH, SHORT_MONTH, MONTH_NUMBER = "MMMM yyyy", "MMM yyyy", "M yyyy"


def month_start(col) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_col(col).cast("date"), "month")


def parse_month(col, prefix: str = "") -> Column:
    """``<prefix>August-2026`` -> 2026-08-01, else null.

    Any letter case and separator, long, short or numeric months, four- or two-digit years.
    """
    text = strip_prefix(col, prefix) if prefix else as_col(col)
    text = F.trim(F.regexp_replace(text, r"[\s\-_/.,]+|(?<=[A-Za-z])(?=\d)", " "))
    for years, century in TWO_DIGIT_YEARS.items():
        text = F.regexp_replace(text, f" ({years})$", f" {century}$1")
    # One attempt per value, chosen by its shape: a failed attempt costs far more than a test.
    named = F.when(F.locate(" ", text) > 4, F.try_to_date(text, LONG_MONTH)).otherwise(F.try_to_date(text, SHORT_MONTH))
    return month_start(F.when(text.rlike(r"^\d"), F.try_to_date(text, MONTH_NUMBER)).otherwise(named))


def calendar_columns(month: str = "report_month") -> dict[str, Column]:
    """Calendar attributes of a month column, by output name."""
    m = F.col(month)
    quarter = F.concat(F.lit("Q"), F.quarter(m).cast("string"))
    return {
        "year": F.year(m),
        "month_number": F.month(m),
        "month_name": F.date_format(m, "MMMM"),
        "month_short": F.date_format(m, "MMM"),
        "year_month": F.date_format(m, "yyyy-MM"),
        "month_year_label": F.date_format(m, "MMM yyyy"),
        "quarter": quarter,
        "year_quarter": F.concat_ws(" ", F.year(m).cast("string"), quarter),
    }


def month_spine(bounds: DataFrame, low: str, high: str, name: str = "report_month") -> DataFrame:
    """One row per month between ``low`` and ``high`` of a one-row frame, gaps included."""
    months = F.sequence(month_start(low), month_start(high), F.expr("INTERVAL 1 MONTH"))
    return bounds.filter(F.col(low).isNotNull()).select(F.explode(months).alias(name))
