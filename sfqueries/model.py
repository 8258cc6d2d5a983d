"""The star model and its reports over the given tables: orders of customers as emergency care,
order lines of suppliers as waiting lists. Facts are saved once and reused, as in the full run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.plans import contracts as C
from tallymart.plans import model
from tallymart.plans.emergency import emergency_sanity
from tallymart.sources import new_stage, save_tables

from .base import WAITS_SQL, query, table
from .dims import CALENDAR_SQL
from .facts import (
    EMERGENCY_SQL,
    PROVIDER_FACT_SQL,
    SPECIALTY_FACT_SQL,
    emergency_fact,
    provider_fact_of,
    specialty_fact_of,
    staged_totals,
)


def _facts(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = nations.select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("place"), F.col("r_name").alias("region")
    )
    # A nation's code and a supplier's code share numbers, so some providers appear in both sources.
    ae = emergency_fact(spark, sf_dir).join(places, F.col("provider_code") == F.col("nation"))
    ae = ae.withColumn("provider_code", F.col("nation").cast("string")).withColumnRenamed("place", "provider_name")
    ae = ae.withColumn("source_file", F.date_format("report_month", "'ae_'yyyy_MM'.csv'")).select(*C.EMERGENCY_FACT)

    suppliers = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("nation"))
    names = suppliers.select(
        F.col("s_suppkey").alias("supplier"),
        F.col("s_name").alias("provider_org_name"),
        F.concat(F.lit("P"), F.col("nation").cast("string")).alias("provider_parent_org_code"),
        F.col("place").alias("provider_parent_name"),
    )
    totals = staged_totals(spark, sf_dir)

    def named(fact):
        joined = fact.join(names, F.col("provider_org_code") == F.col("supplier"))
        return joined.withColumn("provider_org_code", F.col("supplier").cast("string")).drop("supplier")

    measures = [*C.WAITING_MEASURES, "within_18_weeks_pct"]
    return {
        "fact_ae": ae,
        "fact_rtt_provider": named(provider_fact_of(totals)).select(*C.PROVIDER_KEYS, *measures),
        "fact_rtt_specialty": named(specialty_fact_of(totals)).select(
            *C.PROVIDER_KEYS, *C.FUNCTION_KEYS, *measures
        ),
    }


def star(spark, sf_dir):
    stage = new_stage(spark, "star")
    tables = save_tables(_facts(spark, sf_dir), stage)
    return tables | save_tables(model.build_dimensions(tables), stage)


STAR_SQL = f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, {SPECIALTY_FACT_SQL}, {EMERGENCY_SQL},
ae AS (SELECT f.* EXCLUDE (provider_code), CAST(provider_code AS VARCHAR) AS provider_code, n_name AS provider_name,
       r_name AS region FROM fact_ae f JOIN nation ON n_nationkey = provider_code JOIN region ON r_regionkey = n_regionkey),
names AS (SELECT s_suppkey, s_name AS provider_org_name, 'P' || n_nationkey AS provider_parent_org_code,
       n_name AS provider_parent_name FROM supplier JOIN nation ON n_nationkey = s_nationkey),
rp AS (SELECT n.* EXCLUDE (s_suppkey), f.* REPLACE (CAST(provider_org_code AS VARCHAR) AS provider_org_code)
       FROM fact_provider f JOIN names n ON s_suppkey = provider_org_code),
rs AS (SELECT n.* EXCLUDE (s_suppkey), f.* REPLACE (CAST(provider_org_code AS VARCHAR) AS provider_org_code)
       FROM fact_specialty f JOIN names n ON s_suppkey = provider_org_code),
months AS (SELECT min(m) AS lo, max(m) AS hi FROM (
  SELECT report_month AS m FROM ae UNION ALL SELECT report_month FROM rp UNION ALL SELECT report_month FROM rs)),
dim_date AS (SELECT d AS report_month, {CALENDAR_SQL} FROM (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d FROM months)),
history AS (
  SELECT 1 AS source, report_month, provider_code AS code, provider_name AS name, CAST(NULL AS VARCHAR) AS pc, region AS pn FROM ae
  UNION ALL SELECT 2, report_month, provider_org_code, provider_org_name, provider_parent_org_code, provider_parent_name FROM rp),
dim_provider AS (SELECT code AS provider_code,
  last(name ORDER BY source, report_month, pc, pn, name) FILTER (name IS NOT NULL) AS provider_name,
  first(pc ORDER BY source, report_month, pc, pn, name) FILTER (pc IS NOT NULL) AS provider_parent_code,
  last(pn ORDER BY source, report_month, pc, pn, name) FILTER (pn IS NOT NULL) AS provider_parent_name,
  bool_or(source = 1) AS appears_in_ae, bool_or(source = 2) AS appears_in_rtt
  FROM history GROUP BY code),
dim_specialty AS (SELECT DISTINCT treatment_function_code, treatment_function_name FROM rs)"""


@query("model_dim_date", "M1 X7 X11", f"{STAR_SQL} SELECT * FROM dim_date")
def model_dim_date(spark, sf_dir):
    return model.build_dimensions(_facts(spark, sf_dir))["dim_date"]


@query("model_dim_provider", "M2 A20 A21", f"{STAR_SQL} SELECT * FROM dim_provider")
def model_dim_provider(spark, sf_dir):
    return model.build_dimensions(_facts(spark, sf_dir))["dim_provider"]


@query("model_dim_specialty", "M3", f"{STAR_SQL} SELECT * FROM dim_specialty ORDER BY treatment_function_name")
def model_dim_specialty(spark, sf_dir):
    return model.build_dimensions(_facts(spark, sf_dir))["dim_specialty"]


@query(
    "model_renamed_providers",
    "A5",
    f"""{STAR_SQL} SELECT code AS provider_code, count(DISTINCT name) AS name_count FROM history
GROUP BY ALL HAVING count(DISTINCT name) > 1""",
)
def model_renamed_providers(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return model.renamed_providers(model.provider_history(facts["fact_ae"], facts["fact_rtt_provider"]))


_TABLES_SQL = {"fact_ae": "ae", "fact_rtt_provider": "rp", "fact_rtt_specialty": "rs"}


@query(
    "model_row_counts",
    "A24 S12 S13",
    STAR_SQL
    + " UNION ALL ".join(
        f" SELECT '{t}' AS table_name, count(*) AS row_count FROM {_TABLES_SQL.get(t, t)}" for t in C.MODEL_TABLES
    ),
)
def model_row_counts(spark, sf_dir):
    return model.validate(star(spark, sf_dir))["model_row_counts"]


def _dup(name, keys):
    return f"(SELECT count(*) FROM (SELECT {keys} FROM {name} GROUP BY ALL HAVING count(*) > 1))"


def _fk(fact, key, dim, dim_key):
    return f"(SELECT count(*) FROM {fact} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} IS NOT DISTINCT FROM f.{key}))"


def _rule(fact, rule):
    return f"(SELECT count_if({rule}) FROM {fact})"


_SPLIT = "within_18_weeks + over_18_weeks <> total_waiting"
_ISSUES_SQL = [
    _dup("ae", "report_month, provider_code"),
    _dup("rp", "report_month, provider_org_code"),
    _dup("rs", "report_month, provider_org_code, treatment_function_code"),
    _dup("dim_date", "report_month"),
    _dup("dim_provider", "provider_code"),
    _dup("dim_specialty", "treatment_function_code"),
    _fk("ae", "report_month", "dim_date", "report_month"),
    _fk("rp", "report_month", "dim_date", "report_month"),
    _fk("rs", "report_month", "dim_date", "report_month"),
    _fk("ae", "provider_code", "dim_provider", "provider_code"),
    _fk("rp", "provider_org_code", "dim_provider", "provider_code"),
    _fk("rs", "provider_org_code", "dim_provider", "provider_code"),
    _fk("rs", "treatment_function_code", "dim_specialty", "treatment_function_code"),
    _rule("ae", "ae_4_hour_performance_pct < 0"),
    _rule("ae", "ae_4_hour_performance_pct > 1"),
    _rule("rp", _SPLIT),
    _rule("rs", _SPLIT),
    _rule("rp", "within_18_weeks_pct < 0"),
    _rule("rp", "within_18_weeks_pct > 1"),
    _rule("rs", "within_18_weeks_pct < 0"),
    _rule("rs", "within_18_weeks_pct > 1"),
]


@query(
    "model_qa_summary",
    "V4 V5 V6 V7 A17 A25 J3 J4",
    f"""{STAR_SQL}, issues AS ({' UNION ALL '.join(
        f"SELECT '{c}' AS " + '"check"' + f", CAST({q} AS BIGINT) AS issue_count" for c, q in zip(C.QA_CHECKS, _ISSUES_SQL)
    )}) SELECT *, CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM issues""",
)
def model_qa_summary(spark, sf_dir):
    return model.validate(star(spark, sf_dir))["qa_summary"]


_EXTENDED_SQL = {
    **{
        f"A&E negative {c}": _rule("ae", f"{c} < 0")
        for c in ("total_attendances", "total_over4", "within_4_hours", "total_emergency_admissions")
    },
    **{f"RTT provider negative {c}": _rule("rp", f"{c} < 0") for c in C.WAITING_MEASURES},
    "RTT total waiting differs between facts": """(SELECT count(*) FROM rp p JOIN (
      SELECT report_month, provider_org_code, sum(total_waiting) AS t FROM rs GROUP BY ALL) s
      USING (report_month, provider_org_code) WHERE p.total_waiting <> s.t)""",
    "RTT provider months without specialties": """(SELECT count(*) FROM rp p WHERE NOT EXISTS (
      SELECT 1 FROM rs s WHERE s.report_month = p.report_month AND s.provider_org_code = p.provider_org_code))""",
    "RTT specialty months without providers": """(SELECT count(*) FROM (
      SELECT DISTINCT report_month, provider_org_code FROM rs) s WHERE NOT EXISTS (
      SELECT 1 FROM rp p WHERE s.report_month = p.report_month AND s.provider_org_code = p.provider_org_code))""",
}


@query(
    "model_extended_checks",
    "V6 V7 A17 A25",
    f"""{STAR_SQL}, issues AS ({' UNION ALL '.join(
        f"SELECT '{c}' AS " + '"check"' + f", CAST({q} AS BIGINT) AS issue_count" for c, q in _EXTENDED_SQL.items()
    )}) SELECT *, CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM issues""",
)
def model_extended_checks(spark, sf_dir):
    return model.extended_checks(star(spark, sf_dir))


@query(
    "model_reconciliation",
    "V3 A18",
    f"""{STAR_SQL}, d AS (SELECT p.total_waiting - s.t AS d FROM rp p LEFT JOIN (
  SELECT report_month, provider_org_code, CAST(sum(total_waiting) AS BIGINT) AS t FROM rs GROUP BY ALL) s
  USING (report_month, provider_org_code))
SELECT count(*) AS provider_month_rows, CAST(count_if(d = 0) AS BIGINT) AS total_waiting_exact_matches,
  CAST(count_if(d <> 0) AS BIGINT) AS total_waiting_mismatches, max(abs(d)) AS max_absolute_total_difference FROM d""",
)
def model_reconciliation(spark, sf_dir):
    return model.validate(star(spark, sf_dir))["rtt_reconciliation_summary"]


@query(
    "model_emergency_sanity",
    "A17",
    f"""{STAR_SQL} SELECT CAST(count_if(within_4_hours < 0) AS BIGINT) AS negative_within_4,
  CAST(count_if(total_attendances < 0) AS BIGINT) AS negative_total_attendances,
  CAST(count_if(total_emergency_admissions < 0) AS BIGINT) AS negative_total_emergency_admissions,
  min(ae_4_hour_performance_pct) AS min_ae_4_hour_performance_pct,
  max(ae_4_hour_performance_pct) AS max_ae_4_hour_performance_pct FROM ae""",
)
def model_emergency_sanity(spark, sf_dir):
    return emergency_sanity(_facts(spark, sf_dir)["fact_ae"])
