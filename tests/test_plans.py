"""From raw files to reports, with planted defects."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.operators import grain_checks, match_tally, missing_keys
from tallymart.plans import contracts as C
from tallymart.plans import emergency, model, waiting
from tallymart.plans.run import build_model, export_model, stage_waiting, write_extra, write_profile, write_validation
from tallymart.sources import read_csv, zip_catalogue
from published import ae_row, ae_total, waiting_csv, waiting_row, write_ae, write_zip

APRIL, MAY, JUNE = (dt.date(2026, m, 1) for m in (4, 5, 6))
NORTH, SOUTH = ("Q1", "North"), ("Q2", "South")
RA, RB = ("RA", "Alpha"), ("RB", "Beta")
ALL, HEART, SKIN = ("C_999", "Total"), ("C_320", "Cardiology Service"), ("C_330", "Dermatology Service")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    april = [ae_row("MSitAE-APRIL-2026", "RA", "Alpha A&E", "North region", 5), ae_row("MSitAE-APRIL-2026", "RC", "Gamma", "East", 3)]
    write_ae(root / "ae" / "ae_2026_04.csv", [*april, ae_total(april)])
    june = [ae_row("MSitAE-June-2026", "RA", "Alpha renamed", "North region", 7)]
    june[0]["attendances_over_4hrs_type_1"] = None
    total = ae_total(june)
    total["other_emergency_admissions"] += 1
    write_ae(root / "ae" / "ae_2026_06.csv", [*june, total], columns=list(reversed(april[0])))

    def month(period, scale):
        return [
            waiting_row(period, NORTH, RA, ALL, {0: 10 * scale, 17: 1, 18: 2, 52: 3, 104: 4}),
            waiting_row(period, NORTH, RA, HEART, {0: 10 * scale, 17: 1, 18: 2}),
            waiting_row(period, NORTH, RA, SKIN, {52: 3, 104: 4}),
            waiting_row(period, SOUTH, RB, ALL, {65: 5, 78: 6}),
            waiting_row(period, SOUTH, RB, HEART, {65: 5}),
            waiting_row(period, SOUTH, RB, HEART, {78: 6}),
            waiting_row(period, SOUTH, RB, SKIN, {1: 99}, part="Part_1A"),
        ]

    write_zip(root / "rtt" / "apr.zip", {"20260430-RTT-April-2026-full-extract.csv": waiting_csv(month("RTT-April-2026", 1))})
    may = month("RTT-May-2026", 2)
    write_zip(
        root / "rtt" / "may.zip",
        {"a/20260531-RTT-May-2026-a.csv": waiting_csv(may[:3]), "b/20260531-RTT-May-2026-b.csv": waiting_csv(may[3:])},
    )
    return root


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    rows, _ = stage_waiting(spark, str(raw / "rtt"))
    return build_model(emergency.read_emergency(spark, str(raw / "ae")), rows, out), out


def test_emergency_fact(built):
    fact = built[0]["fact_ae"]
    assert fact.columns == C.EMERGENCY_FACT
    got = {(r.report_month, r.provider_code): r for r in fact.collect()}
    assert set(got) == {(APRIL, "RA"), (APRIL, "RC"), (JUNE, "RA")}
    a = got[APRIL, "RA"]
    attended = sum(50 + i for i in range(6))
    late = sum(5 + i for i in range(6, 12))
    assert (a.total_attendances, a.total_over4, a.within_4_hours) == (attended, late, attended - late)
    assert a.ae_4_hour_performance_pct == (attended - late) / attended
    assert a.dta_4_plus_hours == 5 + 12 + 5 + 13
    assert a.emergency_admissions_via_ae == 5 * 3 + 14 + 15 + 16
    assert a.total_emergency_admissions == a.emergency_admissions_via_ae + 5 + 17
    assert a.source_file == "ae_2026_04.csv"
    j = got[JUNE, "RA"]
    assert j.total_attendances is not None
    assert j.total_over4 is None and j.within_4_hours is None and j.ae_4_hour_performance_pct is None


def test_published_totals(spark, raw):
    checked = emergency.emergency_totals_check(emergency.read_emergency(spark, str(raw / "ae")))
    assert checked.count() == 2 * len(C.EMERGENCY_COUNTS)
    assert {r.matches: r.n for r in match_tally(checked).collect()} == {True: 2 * len(C.EMERGENCY_COUNTS) - 1, False: 1}
    wrong = checked.filter(~F.col("matches")).first()
    assert (wrong.source_file, wrong.metric, wrong.difference) == ("ae_2026_06.csv", "other_emergency_admissions", -1)


def test_waiting_facts(built):
    tables = built[0]
    provider = {(r.report_month, r.provider_org_code): r for r in tables["fact_rtt_provider"].collect()}
    assert set(provider) == {(m, p) for m in (APRIL, MAY) for p in ("RA", "RB")}
    r = provider[APRIL, "RA"]
    assert [r[m] for m in C.WAITING_MEASURES] == [20, 11, 9, 7, 4, 4, 4]
    assert r.within_18_weeks_pct == 11 / 20
    assert [provider[MAY, "RB"][m] for m in C.WAITING_MEASURES] == [11, 0, 11, 11, 11, 6, 0]
    specialty = {
        (r.report_month, r.provider_org_code, r.treatment_function_code): r.total_waiting
        for r in tables["fact_rtt_specialty"].collect()
    }
    assert len(specialty) == 6
    assert specialty[MAY, "RB", "C_320"] == 11 and specialty[MAY, "RA", "C_320"] == 23


def test_band_check_needs_no_second_pass(spark, raw, built):
    incomplete = waiting.incomplete_pathways(waiting.read_waiting(spark, str(raw / "rtt")))
    direct = waiting.backlog_check(incomplete).first().asDict()
    assert direct == waiting.backlog_check_from_totals(waiting.function_totals(incomplete)).first().asDict()
    assert direct == spark.read.parquet(f"{built[1]}/model/backlog_check").first().asDict()
    assert (direct["rows"], direct["total_matches"], direct["total_mismatches"]) == (12, 12, 0)


def test_dimensions(built):
    tables = built[0]
    assert [r.year_month for r in tables["dim_date"].orderBy("report_month").collect()] == ["2026-04", "2026-05", "2026-06"]
    providers = {r.provider_code: tuple(r)[1:] for r in tables["dim_provider"].collect()}
    assert providers == {
        "RA": ("Alpha", "Q1", "North", True, True),  # the June name of the other source is newer but loses
        "RB": ("Beta", "Q2", "South", False, True),
        "RC": ("Gamma", None, "East", True, False),
    }
    assert {tuple(r) for r in tables["dim_specialty"].collect()} == {HEART, SKIN}
    history = model.provider_history(tables["fact_ae"], tables["fact_rtt_provider"])
    assert [tuple(r) for r in model.renamed_providers(history).collect()] == [("RA", 3)]


def read_report(folder):
    lines = []
    for part in sorted(folder.glob("part-*.csv")):
        lines += list(csv.reader(part.open()))[1:]
    return [tuple(x) for x in lines]


def test_exports_and_reports(spark, raw, built, tmp_path):
    tables = built[0]
    before = write_validation(spark, tables, str(tmp_path / "early"))
    assert {x for _, x in read_report(tmp_path / "early" / "validation" / "export_check.csv")} == {"FALSE"}
    export_model(tables, str(tmp_path))
    assert write_validation(spark, tables, str(tmp_path)) == before
    reports = tmp_path / "validation"
    assert dict(read_report(reports / "export_check.csv")) == {f"{t}.csv": "TRUE" for t in C.MODEL_TABLES}
    assert dict(read_report(reports / "model_row_counts.csv")) == {
        "fact_ae": "3", "fact_rtt_provider": "4", "fact_rtt_specialty": "6",
        "dim_date": "3", "dim_provider": "3", "dim_specialty": "2",
    }
    assert read_report(reports / "qa_summary.csv") == [(c, "0", "PASS") for c in C.QA_CHECKS]
    assert read_report(reports / "rtt_reconciliation_summary.csv") == [("4", "4", "0", "0")]
    assert len(read_report(reports / "rtt_provider_specialty_reconciliation.csv")) == 4

    names = write_profile(*stage_waiting(spark, str(raw / "rtt")), str(tmp_path))
    assert len(names) == 7
    profiles = tmp_path / "data_quality"
    assert {c for _, c in read_report(profiles / "rtt_column_counts.csv")} == {"121"}
    assert {n for _, n in read_report(profiles / "rtt_schema_check.csv")} == {"3"}
    types = dict(read_report(profiles / "rtt_type_profile.csv"))
    assert len(types) == 122 and types["period"] == "character" and types["total_all"] == "numeric"
    missing = {r[0]: r[1:] for r in read_report(profiles / "rtt_missing_profile.csv")}
    assert missing["total"] == ("14", "100.0") and missing["total_all"] == ("0", "0.0")
    assert missing["commissioner_parent_name"] == ("14", "100.0")
    distinct = dict(read_report(profiles / "rtt_character_profile.csv"))
    assert distinct["source_file"] == "3" and distinct["commissioner_parent_name"] == "1"
    assert sum(int(n) for _, n in read_report(profiles / "rtt_rows_by_file.csv")) == 14
    numeric = {r[0]: r[1:] for r in read_report(profiles / "rtt_numeric_profile.csv")}
    assert len(numeric) == 108 and numeric["gt_00_to_01_weeks_sum_1"] == ("10", "20", "0", "0")


def test_choosing_a_part_in_the_scan_changes_nothing(spark, raw, built):
    rows = waiting.read_waiting(spark, str(raw / "rtt"), part=C.INCOMPLETE)
    assert rows.count() == 12
    totals = waiting.function_totals(waiting.incomplete_pathways(rows))
    assert waiting.provider_fact(totals).exceptAll(built[0]["fact_rtt_provider"]).count() == 0


def broken(tables, **changes):
    return {**tables, **changes}


def issues(tables):
    return {r.check: r.issue_count for r in model.quality_checks(tables).collect() if r.issue_count}


def test_each_defect_is_found_by_its_check(spark, built):
    t = built[0]
    assert issues(t) == {}
    ae, provider, specialty = t["fact_ae"], t["fact_rtt_provider"], t["fact_rtt_specialty"]

    one = ae.filter("provider_code = 'RC'")
    assert issues(broken(t, fact_ae=ae.union(one))) == {"A&E fact duplicate keys": 1}

    renamed = provider.filter("report_month = '2026-04-01' AND provider_org_code = 'RA'")
    renamed = renamed.withColumn("provider_org_name", F.lit("renamed inside a month"))
    assert issues(broken(t, fact_rtt_provider=provider.union(renamed))) == {"RTT provider fact duplicate keys": 1}

    assert issues(broken(t, dim_date=t["dim_date"].filter("year_month <> '2026-06'"))) == {"A&E missing date keys": 1}
    assert issues(broken(t, dim_provider=t["dim_provider"].filter("provider_code <> 'RB'"))) == {
        "RTT provider missing provider keys": 2,
        "RTT specialty missing provider keys": 2,
    }
    assert issues(broken(t, dim_specialty=t["dim_specialty"].filter("treatment_function_code = 'C_330'"))) == {
        "RTT missing specialty keys": 4
    }
    assert issues(broken(t, dim_specialty=t["dim_specialty"].union(t["dim_specialty"]))) == {
        "Specialty dimension duplicate keys": 2
    }

    no_code = ae.withColumn("provider_code", F.nullif("provider_code", F.lit("RC")))
    assert issues(broken(t, fact_ae=no_code)) == {"A&E missing provider keys": 1}
    with_null = t["dim_provider"].unionByName(
        spark.createDataFrame([(None, None, None, None, False, False)], t["dim_provider"].schema)
    )
    assert issues(broken(t, fact_ae=no_code, dim_provider=with_null)) == {}

    late = ae.withColumn("ae_4_hour_performance_pct", -F.col("ae_4_hour_performance_pct"))
    assert issues(broken(t, fact_ae=late)) == {"A&E performance below 0": 2}
    high = specialty.withColumn("within_18_weeks_pct", F.col("within_18_weeks_pct") + 1)
    assert issues(broken(t, fact_rtt_specialty=high)) == {"RTT specialty percentage above 1": 2}
    off = provider.withColumn("over_18_weeks", F.col("over_18_weeks") + 1)
    assert issues(broken(t, fact_rtt_provider=off)) == {"RTT provider reconciliation mismatches": 4}


def test_extended_checks(built):
    t = built[0]
    assert {r.status for r in model.extended_checks(t).collect()} == {"PASS"}
    specialty = t["fact_rtt_specialty"]
    cut = specialty.filter("NOT (provider_org_code = 'RB' AND report_month = '2026-04-01')")
    cut = cut.filter("NOT (provider_org_code = 'RA' AND treatment_function_code = 'C_330' AND report_month = '2026-05-01')")
    less = t["fact_rtt_provider"].filter("NOT (provider_org_code = 'RA' AND report_month = '2026-04-01')")
    found = {
        r.check: r.issue_count
        for r in model.extended_checks(broken(t, fact_rtt_specialty=cut, fact_rtt_provider=less)).collect()
        if r.issue_count
    }
    assert found == {
        "RTT total waiting differs between facts": 1,
        "RTT provider months without specialties": 1,
        "RTT specialty months without providers": 1,
    }


def test_row_level_defects(spark):
    """All bands missing, a total that is off, and a total of 0."""
    rows = [
        waiting_row("RTT-April-2026", NORTH, RA, HEART, {}, total=3),
        waiting_row("RTT-April-2026", NORTH, RA, HEART, {}, total=0),
        waiting_row("RTT-April-2026", NORTH, RA, HEART, {5: 2, 60: 2}, total=5),
        waiting_row("RTT-April-2026", NORTH, RA, HEART, {5: 2, 60: 2}),
    ]
    raw = spark.createDataFrame([tuple(r.get(c) for c in C.WAITING_SCHEMA.names) for r in rows], C.WAITING_SCHEMA)
    incomplete = waiting.incomplete_pathways(raw)
    assert [r.within_18_weeks_pct for r in incomplete.collect()] == [0.0, None, 0.4, 0.5]
    got = waiting.backlog_check(incomplete).first()
    assert (got["rows"], got.total_matches, got.total_mismatches) == (4, 2, 2)
    assert missing_keys(incomplete, incomplete, C.PROVIDER_KEYS).count() == 0


def test_further_reports(spark, built, raw, tmp_path):
    tables = built[0]
    ae = emergency.read_emergency(spark, str(raw / "ae"))
    rows, _ = stage_waiting(spark, str(raw / "rtt"))
    names = write_extra(tables, ae, rows, zip_catalogue(spark, str(raw / "rtt")), str(tmp_path))
    assert len(names) == 9
    totals = read_csv(spark, f"{tmp_path}/reports/emergency_published_totals.csv", lineage=None)
    assert totals.count() > 0 and set(totals.columns) >= {"source_file", "metric", "matches"}
    overview = read_csv(spark, f"{tmp_path}/reports/rtt_dataset_overview.csv", lineage=None).first()
    assert int(overview.total_rows) == rows.count()


def test_each_fact_is_scanned_once_for_its_checks(built):
    """As many scans as tables: the checks of a fact follow from its grain."""
    plan = model.quality_checks(built[0])._jdf.queryExecution().optimizedPlan().toString()
    for fact in ("fact_ae", "fact_rtt_provider", "fact_rtt_specialty"):
        grain = {"fact_ae": "ae_4_hour_performance_pct"}.get(fact, "within_18_weeks_pct")
        assert grain in plan
    assert plan.count("Relation [") <= 13


def test_grain_checks_by_hand(spark):
    rows = [("a", 1, 5), ("a", 1, 6), ("b", 1, -1), ("b", None, 2), ("c", 2, 3), ("c", 2, 3), ("c", 2, 3)]
    fact = spark.createDataFrame(rows, "k string, d int, v int")
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    found = grain_checks(fact, ["k", "d"], "twice", {"lost": (dim, "d", "id")}, {"below": F.col("v") < 0, "three": F.col("v") == 3})
    assert {r.check: r.issue_count for r in found.collect()} == {"twice": 2, "lost": 4, "below": 1, "three": 3}
    empty = grain_checks(fact.limit(0), ["k", "d"], "twice", {"lost": (dim, "d", "id")}, {"below": F.col("v") < 0})
    assert {r.issue_count for r in empty.collect()} == {0}
