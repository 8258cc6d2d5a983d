"""Waiting-list archives -> ``fact_rtt_provider`` and ``fact_rtt_specialty``.

The wide text is read once: 105 bands become six sums per row, rows are summed to
month x provider x function, and that narrow table is staged as Parquet. Both facts and the
row-level band check are derived from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import band_lookup, band_thresholds, parse_month, safe_ratio
from ..operators import build_fact, band_reconciliation
from ..operators.aggregates import total
from ..sources import read_zip_csv
from . import contracts as C


def read_waiting(spark: SparkSession, archives: str, stage: str | None = None, part: str | None = None) -> DataFrame:
    """All archive members, or their rows of one part type, with cleaned names and ``source_file``."""
    where = {"rtt_part_type": part} if part else None
    return read_zip_csv(spark, archives, C.WAITING_SCHEMA, stage=stage, clean=True, where=where)


def incomplete_pathways(raw: DataFrame) -> DataFrame:
    """Incomplete pathways with their month, backlog sums and within-18 share per source row."""
    rows = raw.filter(F.col("rtt_part_type") == C.INCOMPLETE).withColumn(
        "report_month", parse_month("period", C.WAITING_PREFIX)
    )
    bands = band_lookup(rows, C.BAND_PATTERN)
    rows = band_thresholds(rows, bands, C.CUTS).withColumn(
        "within_18_weeks_pct", safe_ratio("within_18_weeks", "total_all")
    )
    return rows.select(
        *C.PROVIDER_KEYS, *C.FUNCTION_KEYS, F.col("total_all").alias("total_waiting"), *C.BACKLOG, "within_18_weeks_pct"
    )


def backlog_check(incomplete: DataFrame) -> DataFrame:
    """One row: source rows whose bands do / do not add up to their total, and the range of the share."""
    return band_reconciliation(
        incomplete, ["within_18_weeks", "over_18_weeks"], "total_waiting", ["within_18_weeks_pct"]
    )


def function_totals(incomplete: DataFrame) -> DataFrame:
    """Backlog by month, provider and function, with the counts ``backlog_check`` needs."""
    bands = F.col("within_18_weeks") + F.col("over_18_weeks")
    pct = "within_18_weeks_pct"
    return incomplete.groupBy(*C.PROVIDER_KEYS, *C.FUNCTION_KEYS).agg(
        *[total(m).alias(m) for m in C.WAITING_MEASURES],
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bands == F.col("total_waiting")).alias("total_matches"),
        F.count_if(bands != F.col("total_waiting")).alias("total_mismatches"),
        F.min(pct).alias(f"min_{pct}"),
        F.max(pct).alias(f"max_{pct}"),
    )


def backlog_check_from_totals(totals: DataFrame) -> DataFrame:
    """The same row as ``backlog_check``, without another pass over the source."""
    pct = "within_18_weeks_pct"
    return totals.agg(
        *[total(c).alias(c) for c in ("rows", "total_matches", "total_mismatches")],
        F.min(f"min_{pct}").alias(f"min_{pct}"),
        F.max(f"max_{pct}").alias(f"max_{pct}"),
    )


def provider_fact(totals: DataFrame) -> DataFrame:
    """Month x provider, from the rows that already cover all functions."""
    rows = totals.filter(F.col("treatment_function_code") == C.ALL_FUNCTIONS)
    return build_fact(rows, C.PROVIDER_KEYS, C.WAITING_MEASURES, C.WAITING_RATIO)


def specialty_fact(totals: DataFrame) -> DataFrame:
    """Month x provider x function, without the all-functions rows."""
    rows = totals.filter(F.col("treatment_function_code") != C.ALL_FUNCTIONS)
    return build_fact(rows, [*C.PROVIDER_KEYS, *C.FUNCTION_KEYS], C.WAITING_MEASURES, C.WAITING_RATIO)
