"""Facts -> dimensions, checks and exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    attribute_dim,
    conflicting_attributes,
    date_dim,
    distinct_on,
    entity_dim,
    grain_checks,
    grain_reconciliation,
    issue_count,
    missing_keys,
    order,
    qa_summary,
    range_check,
    reconciliation_summary,
    stack,
    table_counts,
    unique_key_check,
)
from . import contracts as C

Tables = Mapping[str, DataFrame]


def provider_history(emergency: DataFrame, provider: DataFrame) -> DataFrame:
    """Every published appearance of a provider in a common shape; waiting-list rows come second."""
    return stack(
        emergency.select(
            "provider_code",
            "provider_name",
            F.lit(None).cast("string").alias("provider_parent_code"),
            F.col("region").alias("provider_parent_name"),
            "report_month",
            F.lit(1).alias("source_rank"),
        ),
        provider.select(
            F.col("provider_org_code").alias("provider_code"),
            F.col("provider_org_name").alias("provider_name"),
            F.col("provider_parent_org_code").alias("provider_parent_code"),
            "provider_parent_name",
            "report_month",
            F.lit(2).alias("source_rank"),
        ),
    )


def renamed_providers(history: DataFrame) -> DataFrame:
    """Provider codes published under more than one name."""
    return conflicting_attributes(history, "provider_code", "provider_name")


def provider_dim(history: DataFrame) -> DataFrame:
    """One row per provider code: latest name, earliest parent code, latest parent name, presence."""
    dim = entity_dim(
        history,
        "provider_code",
        source="source_rank",
        period="report_month",
        last=["provider_name", "provider_parent_name"],
        first=["provider_parent_code"],
        tie_break=["provider_parent_code", "provider_parent_name"],
        flags={"appears_in_ae": F.col("source_rank") == 1, "appears_in_rtt": F.col("source_rank") == 2},
    )
    return dim.select(
        "provider_code",
        "provider_name",
        "provider_parent_code",
        "provider_parent_name",
        "appears_in_ae",
        "appears_in_rtt",
    )


def build_dimensions(facts: Tables) -> dict[str, DataFrame]:
    return {
        "dim_date": date_dim([t.select("report_month") for t in facts.values()]),
        "dim_provider": provider_dim(provider_history(facts["fact_ae"], facts["fact_rtt_provider"])),
        "dim_specialty": attribute_dim(
            facts["fact_rtt_specialty"], "treatment_function_code", "treatment_function_name"
        ),
    }


def _share_rules(label: str, pct: str) -> dict:
    return {f"{label} below 0": F.col(pct) < 0, f"{label} above 1": F.col(pct) > 1}


def _waiting_rules(label: str) -> dict:
    bands = F.col("within_18_weeks") + F.col("over_18_weeks")
    return {
        f"{label} reconciliation mismatches": bands != F.col("total_waiting"),
        **_share_rules(f"{label} percentage", "within_18_weeks_pct"),
    }


def quality_checks(t: Tables) -> DataFrame:
    """(check, issue_count, status): the 21 checks. Each fact is scanned once; its checks follow from its grain."""
    month, org, function = "report_month", "provider_org_code", "treatment_function_code"

    def references(label: str, provider: str) -> dict:
        return {
            f"{label} missing date keys": (t["dim_date"], month, month),
            f"{label} missing provider keys": (t["dim_provider"], provider, "provider_code"),
        }

    checks = [
        grain_checks(
            t["fact_ae"], [month, "provider_code"], "A&E fact duplicate keys",
            references("A&E", "provider_code"), _share_rules("A&E performance", "ae_4_hour_performance_pct"),
        ),
        grain_checks(
            t["fact_rtt_provider"], [month, org], "RTT provider fact duplicate keys",
            references("RTT provider", org), _waiting_rules("RTT provider"),
        ),
        grain_checks(
            t["fact_rtt_specialty"], [month, org, function], "RTT specialty fact duplicate keys",
            {**references("RTT specialty", org), "RTT missing specialty keys": (t["dim_specialty"], function, function)},
            _waiting_rules("RTT specialty"),
        ),
        unique_key_check("Date dimension duplicate keys", t["dim_date"], month),
        unique_key_check("Provider dimension duplicate keys", t["dim_provider"], "provider_code"),
        unique_key_check("Specialty dimension duplicate keys", t["dim_specialty"], function),
    ]
    return qa_summary(checks, C.QA_CHECKS)


def extended_checks(t: Tables) -> DataFrame:
    """Checks the summary of 21 leaves out: negative counts and differences between the two facts."""
    ae, provider, specialty = t["fact_ae"], t["fact_rtt_provider"], t["fact_rtt_specialty"]
    keys = ["report_month", "provider_org_code"]
    diffs = fact_reconciliation(provider, specialty)
    counted = ["total_attendances", "total_over4", "within_4_hours", "total_emergency_admissions"]
    checks = [
        range_check(ae, {f"A&E negative {c}": F.col(c) < 0 for c in counted}),
        range_check(provider, {f"RTT provider negative {c}": F.col(c) < 0 for c in C.WAITING_MEASURES}),
        issue_count("RTT total waiting differs between facts", diffs.filter("total_waiting_difference <> 0")),
        issue_count("RTT provider months without specialties", diffs.filter("total_waiting_difference IS NULL")),
        issue_count(
            "RTT specialty months without providers",
            missing_keys(distinct_on(specialty, keys), provider, keys),
        ),
    ]
    return qa_summary(checks)


def fact_reconciliation(provider: DataFrame, specialty: DataFrame) -> DataFrame:
    """Provider fact against the specialty fact summed to month x provider."""
    keys = ["report_month", "provider_org_code"]
    both = grain_reconciliation(provider, specialty, keys, list(C.COMPARED))
    return both.select(
        *keys,
        *C.COMPARED,
        *[F.col(f"fine_{m}").alias(f"specialty_{short}") for m, short in C.COMPARED.items()],
        *[F.col(f"{m}_difference").alias(f"{short}_difference") for m, short in C.COMPARED.items()],
    )


def validate(t: Tables) -> dict[str, DataFrame]:
    """The validation reports by file name, without the presence check of the exports."""
    differences = fact_reconciliation(t["fact_rtt_provider"], t["fact_rtt_specialty"])
    return {
        "model_row_counts": table_counts({n: t[n] for n in C.MODEL_TABLES}),
        "qa_summary": quality_checks(t),
        "rtt_provider_specialty_reconciliation": order(differences, "report_month", "provider_org_code"),
        "rtt_reconciliation_summary": reconciliation_summary(
            differences,
            "total_waiting_difference",
            rows="provider_month_rows",
            matches="total_waiting_exact_matches",
            mismatches="total_waiting_mismatches",
            largest="max_absolute_total_difference",
        ),
    }
