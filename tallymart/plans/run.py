"""All stages, from raw folders to exports.

    spark-submit --py-files tallymart.zip tallymart/plans/run.py RAW_EMERGENCY RAW_ARCHIVES OUT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tallymart.operators import count_by, dataset_overview, missing_profile, numeric_profile, order, profile_report
from tallymart.operators.profile import write_report
from tallymart.plans import contracts as C
from tallymart.plans import emergency, model, waiting
from tallymart.sources import (
    export_check,
    file_manifest,
    new_stage,
    read_csv,
    read_headers,
    save_table,
    save_tables,
    unpack_archives,
    write_csv,
    zip_catalogue,
)

SORT_KEYS = {
    "fact_ae": ["report_month", "provider_code"],
    "fact_rtt_provider": C.PROVIDER_KEYS,
    "fact_rtt_specialty": [*C.PROVIDER_KEYS, *C.FUNCTION_KEYS],
    "dim_date": ["report_month"],
    "dim_provider": ["provider_code"],
    "dim_specialty": ["treatment_function_name"],
}


def stage_waiting(spark: SparkSession, raw_archives: str) -> tuple[DataFrame, DataFrame]:
    """Waiting-list rows as stored Parquet, and the headers of their files.

    The wide text is unpacked and parsed once, for the model and the profiles alike.
    """
    stage = new_stage(spark, "waiting")
    folder = unpack_archives(spark, raw_archives, f"{stage}/unzip")
    manifest = file_manifest(spark, folder)
    rows = read_csv(spark, folder, C.WAITING_SCHEMA, clean=True, keep_extra=True, manifest=manifest)
    return save_table(rows, f"{stage}/rows"), read_headers(spark, folder, manifest=manifest)


def build_model(raw_emergency: DataFrame, raw_waiting: DataFrame, out: str) -> dict[str, DataFrame]:
    """Build the facts and dimensions as Parquet under ``out`` and return them."""
    stage = new_stage(raw_waiting.sparkSession, "model")
    incomplete = waiting.incomplete_pathways(raw_waiting)
    totals = save_table(waiting.function_totals(incomplete), f"{stage}/function_totals")
    facts = {
        "fact_ae": emergency.emergency_fact(raw_emergency),
        "fact_rtt_provider": waiting.provider_fact(totals),
        "fact_rtt_specialty": waiting.specialty_fact(totals),
    }
    tables = save_tables(facts, f"{out}/model", ["report_month"])
    tables |= save_tables(model.build_dimensions(tables), f"{out}/model")
    save_table(waiting.backlog_check_from_totals(totals), f"{out}/model/backlog_check")
    return tables


def export_model(tables: dict[str, DataFrame], out: str) -> None:
    """The six tables as sorted CSV."""
    for name, table in tables.items():
        write_csv(table.orderBy(*SORT_KEYS[name]), f"{out}/processed/{name}.csv")


def write_validation(spark: SparkSession, tables: dict[str, DataFrame], out: str) -> list[str]:
    """Validation reports, and which exports exist."""
    reports = model.validate(tables)
    reports["export_check"] = export_check(spark, [f"{n}.csv" for n in C.MODEL_TABLES], f"{out}/processed")
    return write_report(reports, f"{out}/validation")


def write_profile(rows: DataFrame, headers: DataFrame, out: str) -> list[str]:
    """The seven profile tables of the stored waiting-list rows."""
    return write_report(profile_report(rows, headers), f"{out}/data_quality", "rtt_")


def write_extra(tables: dict[str, DataFrame], raw_emergency: DataFrame, rows: DataFrame, archives: DataFrame, out: str) -> list[str]:
    """What is looked at beside the validation reports: the emergency totals against the published ones, its sanity
    counts and missing cells, renamed providers, further checks, and what the archives and the waiting lists hold."""
    history = model.provider_history(tables["fact_ae"], tables["fact_rtt_provider"])
    reports = {
        "emergency_published_totals": order(emergency.emergency_totals_check(raw_emergency), "source_file", "metric"),
        "emergency_sanity": emergency.emergency_sanity(tables["fact_ae"]),
        "emergency_rows_by_file": order(count_by(raw_emergency, "source_file", "rows"), "source_file"),
        "emergency_missing_profile": missing_profile(raw_emergency),
        "emergency_numeric_profile": numeric_profile(raw_emergency),
        "renamed_providers": order(model.renamed_providers(history), "provider_code"),
        "extended_checks": model.extended_checks(tables),
        "zip_catalogue": order(archives, "source_zip", "file_name"),
        "rtt_dataset_overview": dataset_overview(rows, "source_file"),
    }
    return write_report(reports, f"{out}/reports")


def main(argv: list[str]) -> None:
    raw_emergency, raw_archives, out = argv
    spark = SparkSession.builder.appName("tallymart").getOrCreate()
    rows, headers = stage_waiting(spark, raw_archives)
    ae = save_table(emergency.read_emergency(spark, raw_emergency), f"{new_stage(spark, 'emergency')}/rows")
    tables = build_model(ae, rows, out)
    export_model(tables, out)
    write_validation(spark, tables, out)
    write_profile(rows, headers, out)
    write_extra(tables, ae, rows, zip_catalogue(spark, raw_archives), out)


if __name__ == "__main__":
    main(sys.argv[1:])
