"""Emergency-care files -> ``fact_ae``. Scan, filter and derive are one narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_month, row_sum, safe_ratio, with_measures
from ..operators import drop_totals, published_total_check, sanity_counts
from ..sources import read_csv
from . import contracts as C


def read_emergency(spark: SparkSession, folder: str) -> DataFrame:
    """All monthly files with cleaned names and ``source_file``; published TOTAL rows included."""
    return read_csv(spark, folder, C.EMERGENCY_SCHEMA, clean=True)


def emergency_kpis(df: DataFrame) -> DataFrame:
    """Add the derived measures. A missing component makes its total missing."""
    return with_measures(
        df,
        {
            "total_attendances": row_sum(C.ATTENDANCES, nulls="propagate"),
            "total_over4": row_sum(C.OVER_FOUR, nulls="propagate"),
            "within_4_hours": F.col("total_attendances") - F.col("total_over4"),
            "ae_4_hour_performance_pct": safe_ratio("within_4_hours", "total_attendances"),
            "dta_4_plus_hours": row_sum(C.DECISION_WAITS, nulls="propagate"),
            "emergency_admissions_via_ae": row_sum(C.ADMISSIONS_VIA, nulls="propagate"),
            "total_emergency_admissions": row_sum(
                ["emergency_admissions_via_ae", "other_emergency_admissions"], nulls="propagate"
            ),
        },
    )


def emergency_fact(raw: DataFrame) -> DataFrame:
    """One row per published provider row, at month x provider grain."""
    rows = drop_totals(raw, "period").withColumn("report_month", parse_month("period", C.EMERGENCY_PREFIX))
    return emergency_kpis(rows.withColumnsRenamed(C.EMERGENCY_NAMES)).select(*C.EMERGENCY_FACT)


def emergency_sanity(fact: DataFrame) -> DataFrame:
    """One row: range of the four-hour performance and counts of impossible values."""
    return sanity_counts(
        fact,
        {
            "negative_within_4": F.col("within_4_hours") < 0,
            "negative_total_attendances": F.col("total_attendances") < 0,
            "negative_total_emergency_admissions": F.col("total_emergency_admissions") < 0,
        },
        ranges=["ae_4_hour_performance_pct"],
        rows=None,
    )


def emergency_totals_check(raw: DataFrame) -> DataFrame:
    """Provider rows summed per file against the TOTAL row of that file, per metric."""
    return published_total_check(drop_totals(raw, "period"), drop_totals(raw, "period", keep=True), "source_file")
