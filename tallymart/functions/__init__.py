from .calendar import calendar_columns, month_spine, month_start, parse_month
from .names import (
    band_lookup,
    clean_name,
    clean_names,
    columns_except,
    columns_matching,
    columns_of_type,
    likely_fields,
    unique_clean_names,
)
from .rowwise import band_thresholds, row_sum, safe_ratio, with_measures
from .text import base_name, missing_text, plain_path, strip_prefix

__all__ = [
    "band_lookup",
    "band_thresholds",
    "base_name",
    "calendar_columns",
    "clean_name",
    "clean_names",
    "columns_except",
    "columns_matching",
    "columns_of_type",
    "likely_fields",
    "missing_text",
    "month_spine",
    "month_start",
    "parse_month",
    "plain_path",
    "row_sum",
    "safe_ratio",
    "strip_prefix",
    "unique_clean_names",
    "with_measures",
]
