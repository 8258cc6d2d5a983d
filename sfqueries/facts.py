"""Banded sums, facts and derived measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import (
    band_lookup,
    band_thresholds,
    month_start,
    row_sum,
    safe_ratio,
)
from tallymart.operators import band_reconciliation, build_fact, join_on
from tallymart.plans.contracts import (
    ALL_FUNCTIONS,
    BAND_PATTERN,
    CUTS,
    FUNCTION_KEYS,
    WAITING_MEASURES,
    WAITING_PREFIX,
    WAITING_RATIO,
    band_columns,
)
from tallymart.plans import waiting
from tallymart.plans.emergency import emergency_kpis

from tallymart.sources import new_stage, save_table

from .base import PART_TYPES, WAITS_SQL, backlog_sums_sql, query, table, waits, with_backlog

BAND_KEYS = ["report_month", "provider_org_code", "l_returnflag"]


def bands_to_columns(rows, keys):
    """One row per key with 105 band columns, missing where nothing waits.

    A key has few of the bands, so its sums are gathered as a map and become columns one row at a time. The hash
    table of a pivot holds all 105 cells of every key of a task.
    """
    sums = rows.groupBy(*keys, "band").agg(F.sum("pathways").alias("pathways"))
    cell = F.when(F.col("band").isNotNull(), F.struct("band", "pathways"))
    cells = F.map_from_entries(F.collect_list(cell))
    gathered = sums.groupBy(*keys).agg(cells.alias("cells"))
    return gathered.select(*keys, *[F.col("cells")[w].alias(n) for w, n in enumerate(band_columns())])


def wide_bands(spark, sf_dir):
    """One row per month, provider and part type with 105 band columns."""
    return bands_to_columns(waits(spark, sf_dir), BAND_KEYS)


@query(
    "band_threshold_sums",
    "R4 R6 R7 P9 X3 X4 UD1",
    f"""WITH {WAITS_SQL}
SELECT report_month, provider_org_code, l_returnflag,
       {backlog_sums_sql()}
FROM waits GROUP BY ALL""",
)
def band_threshold_sums(spark, sf_dir):
    wide = wide_bands(spark, sf_dir)
    out = band_thresholds(wide, band_lookup(wide, BAND_PATTERN), CUTS)
    return out.select(*BAND_KEYS, "within_18_weeks", *[f"over_{c}_weeks" for c in CUTS])


@query(
    "row_sum_decimal",
    "R4 R5",
    """SELECT l_orderkey, l_linenumber, CAST(coalesce(CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2)), 0)
         + coalesce(nullif(CAST(round(l_tax, 2) AS DECIMAL(18, 2)), 0.02), 0) AS DOUBLE) AS ignoring,
       CAST(CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2)) + nullif(CAST(round(l_tax, 2) AS DECIMAL(18, 2)), 0.02) AS DOUBLE) AS propagating
FROM lineitem""",
)
def row_sum_decimal(spark, sf_dir):
    """Row sums of decimals keep their pence; a tax of 0.02 counts as missing."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice", 2).cast("decimal(18,2)").alias("price"),
        F.nullif(F.round("l_tax", 2).cast("decimal(18,2)"), F.lit(0.02).cast("decimal(18,2)")).alias("tax"),
    )
    sums = {"ignoring": row_sum(["price", "tax"]), "propagating": row_sum(["price", "tax"], nulls="propagate")}
    return rows.select("l_orderkey", "l_linenumber", *[c.cast("double").alias(n) for n, c in sums.items()])


@query(
    "null_ignoring_row_sum",
    "R4 R5 P5",
    f"""WITH {WAITS_SQL}
SELECT report_month, provider_org_code, l_returnflag,
       CAST(sum(pathways) AS BIGINT) AS all_bands,
       CAST(CASE WHEN count(DISTINCT band) FILTER (band IN (0, 104)) = 2
            THEN sum(pathways) FILTER (band IN (0, 104)) END AS BIGINT) AS first_and_last
FROM waits GROUP BY ALL""",
)
def null_ignoring_row_sum(spark, sf_dir):
    bands = band_columns()
    return wide_bands(spark, sf_dir).select(
        *BAND_KEYS,
        row_sum(bands).alias("all_bands"),
        row_sum([bands[0], bands[-1]], nulls="propagate").alias("first_and_last"),
    )


@query(
    "band_reconciliation",
    "V2 A17 F9",
    f"""WITH {WAITS_SQL}, rows_ AS (
  SELECT report_month, provider_org_code, l_returnflag,
         CAST(coalesce(sum(pathways) FILTER (band < 18), 0) AS BIGINT) AS w,
         CAST(sum(pathways) AS BIGINT) AS parts,
         CAST(sum(CASE WHEN line_number < 7 THEN pathways ELSE 0 END) AS BIGINT) AS total_all
  FROM waits GROUP BY ALL)
SELECT count(*) AS "rows",
       CAST(count_if(parts = total_all) AS BIGINT) AS total_matches,
       CAST(count_if(parts <> total_all) AS BIGINT) AS total_mismatches,
       min(CASE WHEN total_all > 0 THEN w / total_all END) AS min_within_18_weeks_pct,
       max(CASE WHEN total_all > 0 THEN w / total_all END) AS max_within_18_weeks_pct
FROM rows_""",
)
def band_reconciliation_(spark, sf_dir):
    # The stated total leaves out seventh order lines, so some rows do not reconcile.
    stated = F.when(F.col("line_number") < 7, F.col("pathways")).otherwise(F.lit(0))
    rows = with_backlog(waits(spark, sf_dir)).withColumn("total_all", stated)
    rows = build_fact(
        rows,
        BAND_KEYS,
        ["within_18_weeks", "over_18_weeks", "total_all"],
        ("within_18_weeks", "total_all", "within_18_weeks_pct"),
    )
    return band_reconciliation(rows, ["within_18_weeks", "over_18_weeks"], "total_all", ["within_18_weeks_pct"])


def published_rows(spark, sf_dir):
    """Order lines as rows of a waiting-list file: a wide row per month, provider, part type and function, and one
    for all functions together."""
    own = F.struct("treatment_function_code", "treatment_function_name")
    everything = F.struct(F.lit(ALL_FUNCTIONS).alias("treatment_function_code"), F.lit("Total").alias("treatment_function_name"))
    rows = waits(spark, sf_dir).drop("line_number")
    rows = rows.select("report_month", "provider_org_code", "l_returnflag", "band", "pathways", F.inline(F.array(own, everything)))
    keys = ["report_month", "provider_org_code", "l_returnflag", *FUNCTION_KEYS]
    wide = bands_to_columns(rows, keys)
    part = F.create_map(*[F.lit(x) for pair in PART_TYPES.items() for x in pair])[F.col("l_returnflag")]
    named = {
        "period": F.concat(F.lit(WAITING_PREFIX), F.date_format("report_month", "MMMM-yyyy")),
        "rtt_part_type": part,
        "provider_org_code": F.col("provider_org_code").cast("string"),
        "provider_org_name": F.concat(F.lit("Provider "), F.col("provider_org_code").cast("string")),
        "provider_parent_org_code": F.lit("P1"),
        "provider_parent_name": F.lit("Parent"),
        "total_all": row_sum(band_columns(), dtype="bigint"),
    }
    return wide.withColumns(named).drop("report_month", "l_returnflag")


_PUBLISHED_SQL = f"""published AS (
  SELECT report_month, 'P1' AS provider_parent_org_code, 'Parent' AS provider_parent_name,
         CAST(provider_org_code AS VARCHAR) AS provider_org_code, 'Provider ' || provider_org_code AS provider_org_name,
         f.code AS treatment_function_code, f.name AS treatment_function_name, CAST(sum(pathways) AS BIGINT) AS total_waiting,
         {backlog_sums_sql()}
  FROM (SELECT *, unnest([{{'code': treatment_function_code, 'name': treatment_function_name}},
                          {{'code': '{ALL_FUNCTIONS}', 'name': 'Total'}}]) AS f FROM waits WHERE l_returnflag = 'N') GROUP BY ALL),
shared AS (SELECT *, CASE WHEN total_waiting > 0 THEN within_18_weeks / total_waiting END AS within_18_weeks_pct FROM published)"""


@query("incomplete_pathways", "K8", f"WITH {WAITS_SQL}, {_PUBLISHED_SQL} SELECT * FROM shared")
def incomplete_pathways_(spark, sf_dir):
    """The shipped job's first step, over rows shaped like the published files."""
    return waiting.incomplete_pathways(published_rows(spark, sf_dir))


def _job_totals(spark, sf_dir):
    totals = waiting.function_totals(waiting.incomplete_pathways(published_rows(spark, sf_dir)))
    return save_table(totals, f"{new_stage(spark, 'job')}/totals")


@query(
    "job_provider_fact",
    "K8 F2 A13 A15",
    f"""WITH {WAITS_SQL}, {_PUBLISHED_SQL} SELECT * EXCLUDE (treatment_function_code, treatment_function_name) FROM shared
WHERE treatment_function_code = '{ALL_FUNCTIONS}'""",
)
def job_provider_fact(spark, sf_dir):
    return waiting.provider_fact(_job_totals(spark, sf_dir))


@query(
    "job_specialty_fact",
    "K8 F3 A13 A15",
    f"WITH {WAITS_SQL}, {_PUBLISHED_SQL} SELECT * FROM shared WHERE treatment_function_code <> '{ALL_FUNCTIONS}'",
)
def job_specialty_fact(spark, sf_dir):
    return waiting.specialty_fact(_job_totals(spark, sf_dir))


@query(
    "job_backlog_check",
    "V2 K8",
    f"""WITH {WAITS_SQL}, {_PUBLISHED_SQL} SELECT CAST(count(*) AS BIGINT) AS "rows",
  CAST(count_if(within_18_weeks + over_18_weeks = total_waiting) AS BIGINT) AS total_matches,
  CAST(count_if(within_18_weeks + over_18_weeks <> total_waiting) AS BIGINT) AS total_mismatches,
  min(within_18_weeks_pct) AS min_within_18_weeks_pct, max(within_18_weeks_pct) AS max_within_18_weeks_pct FROM shared""",
)
def job_backlog_check(spark, sf_dir):
    return waiting.backlog_check_from_totals(_job_totals(spark, sf_dir))


def source_rows(spark, sf_dir):
    """Incomplete pathways as published: a row per function, and one more for all functions together."""
    rows = with_backlog(waits(spark, sf_dir, part="N"))
    own = F.struct("treatment_function_code", "treatment_function_name")
    everything = F.struct(
        F.lit(ALL_FUNCTIONS).alias("treatment_function_code"), F.lit("Total").alias("treatment_function_name")
    )
    return rows.select(
        "report_month", "provider_org_code", *WAITING_MEASURES, F.inline(F.array(own, everything))
    )


GRAIN = ["report_month", "provider_org_code"]


def provider_fact_of(rows):
    return build_fact(
        rows.filter(F.col("treatment_function_code") == ALL_FUNCTIONS), GRAIN, WAITING_MEASURES, WAITING_RATIO
    )


def specialty_fact_of(rows):
    return build_fact(
        rows.filter(F.col("treatment_function_code") != ALL_FUNCTIONS),
        [*GRAIN, "treatment_function_code", "treatment_function_name"],
        WAITING_MEASURES,
        WAITING_RATIO,
    )


def provider_fact(spark, sf_dir):
    return provider_fact_of(source_rows(spark, sf_dir))


def specialty_fact(spark, sf_dir):
    return specialty_fact_of(source_rows(spark, sf_dir))


def staged_totals(spark, sf_dir):
    """Backlog by month, provider and function, saved once for queries that need both facts."""
    keys = [*GRAIN, "treatment_function_code", "treatment_function_name"]
    totals = build_fact(source_rows(spark, sf_dir), keys, WAITING_MEASURES)
    return save_table(totals, f"{new_stage(spark, 'totals')}/by_function")


PROVIDER_FACT_SQL = f"""fact_provider AS (
  SELECT *, CASE WHEN total_waiting > 0 THEN within_18_weeks / total_waiting END AS within_18_weeks_pct FROM (
  SELECT report_month, provider_org_code,
         CAST(sum(pathways) AS BIGINT) AS total_waiting,
         {backlog_sums_sql()}
  FROM waits WHERE l_returnflag = 'N' GROUP BY ALL))"""

SPECIALTY_FACT_SQL = f"""fact_specialty AS (
  SELECT *, CASE WHEN total_waiting > 0 THEN within_18_weeks / total_waiting END AS within_18_weeks_pct FROM (
  SELECT report_month, provider_org_code, treatment_function_code, treatment_function_name,
         CAST(sum(pathways) AS BIGINT) AS total_waiting,
         {backlog_sums_sql()}
  FROM waits WHERE l_returnflag = 'N' GROUP BY ALL))"""


def with_provider_names(fact, spark, sf_dir):
    """Attach names after aggregating, when a provider is one row per month."""
    parents = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("provider_parent_org_code"), F.col("n_name").alias("provider_parent_name")
    )
    names = table(spark, sf_dir, "supplier").join(
        parents, F.col("s_nationkey") == F.col("provider_parent_org_code"), "left"
    )
    names = names.select(
        F.col("s_suppkey").alias("provider_org_code"),
        F.col("s_name").alias("provider_org_name"),
        "provider_parent_org_code",
        "provider_parent_name",
    )
    return join_on(fact, names, "provider_org_code", null_safe=False)


NAMED_SQL = """LEFT JOIN supplier ON s_suppkey = provider_org_code
LEFT JOIN nation ON n_nationkey = s_nationkey"""


@query(
    "fact_provider",
    "F2 A13 A15 F9 J1",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}
SELECT f.*, s_name AS provider_org_name, n_nationkey AS provider_parent_org_code, n_name AS provider_parent_name
FROM fact_provider f {NAMED_SQL}""",
)
def fact_provider(spark, sf_dir):
    return with_provider_names(provider_fact(spark, sf_dir), spark, sf_dir)


@query(
    "fact_specialty",
    "F3 A13 A15 F9",
    f"""WITH {WAITS_SQL}, {SPECIALTY_FACT_SQL}
SELECT f.*, s_name AS provider_org_name, n_nationkey AS provider_parent_org_code, n_name AS provider_parent_name
FROM fact_specialty f {NAMED_SQL}""",
)
def fact_specialty(spark, sf_dir):
    return with_provider_names(specialty_fact(spark, sf_dir), spark, sf_dir)


# Emergency-care measures from orders: status and priority stand for department and urgency.

_URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
_LONG = "o_totalprice > 250000"
_WAIT = "o_totalprice > 400000"
_STATUS = {"type1": "F", "type2": "O", "other": "P"}


def _emergency_sources() -> dict[str, str]:
    """Source count -> SQL predicate both engines share."""
    out = {}
    for dept, status in _STATUS.items():
        here = f"o_orderstatus = '{status}'"
        out[f"attendances_{dept}"] = f"{here} AND {_URGENT}"
        out[f"attendances_booked_{dept}"] = f"{here} AND NOT {_URGENT}"
        out[f"over4_{dept}"] = f"{here} AND {_URGENT} AND {_LONG}"
        out[f"over4_booked_{dept}"] = f"{here} AND NOT {_URGENT} AND {_LONG}"
        ending = "other_ae" if dept == "other" else dept
        out[f"emergency_admissions_{ending}"] = f"{here} AND {_LONG} AND {_URGENT}"
    out["dta_4_12_hours"] = f"{_LONG} AND NOT {_WAIT}"
    out["dta_12_plus_hours"] = _WAIT
    out["other_emergency_admissions"] = f"NOT {_LONG} AND {_URGENT}"
    return out


# A count of 3 for this source is treated as not published, to show how a missing part spreads.
_UNPUBLISHED = "attendances_booked_type1"


def emergency_rows(spark, sf_dir):
    """Published counts per month and nation of the customer."""
    orders = table(spark, sf_dir, "orders").select(
        month_start("o_orderdate").alias("report_month"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    counts = [F.count_if(F.expr(p)).alias(n) for n, p in _emergency_sources().items()]
    rows = placed.groupBy("report_month", F.col("c_nationkey").alias("provider_code")).agg(*counts)
    return rows.withColumn(_UNPUBLISHED, F.nullif(F.col(_UNPUBLISHED), F.lit(3)))


_COUNTS_SQL = ",\n         ".join(
    f"CAST(count_if({p}) AS BIGINT) AS {n}" if n != _UNPUBLISHED else f"CAST(nullif(count_if({p}), 3) AS BIGINT) AS {n}"
    for n, p in _emergency_sources().items()
)
_ATT = " + ".join(f"attendances_{b}{d}" for b in ("", "booked_") for d in _STATUS)
_OVER = " + ".join(f"over4_{b}{d}" for b in ("", "booked_") for d in _STATUS)

EMERGENCY_SQL = f"""emergency AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, c_nationkey AS provider_code,
         {_COUNTS_SQL}
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
fact_ae AS (
  SELECT *, total_attendances - total_over4 AS within_4_hours,
         CASE WHEN total_attendances > 0 THEN (total_attendances - total_over4) / total_attendances END
           AS ae_4_hour_performance_pct,
         emergency_admissions_via_ae + other_emergency_admissions AS total_emergency_admissions
  FROM (SELECT *, {_ATT} AS total_attendances, {_OVER} AS total_over4,
               dta_4_12_hours + dta_12_plus_hours AS dta_4_plus_hours,
               emergency_admissions_type1 + emergency_admissions_type2 + emergency_admissions_other_ae
                 AS emergency_admissions_via_ae
        FROM emergency))"""


def emergency_fact(spark, sf_dir):
    return emergency_kpis(emergency_rows(spark, sf_dir))


@query(
    "fact_ae_kpis",
    "K1 K2 K3 K4 K5 K6 K7 P8 R5 F9",
    f"WITH {EMERGENCY_SQL} SELECT * FROM fact_ae",
)
def fact_ae_kpis(spark, sf_dir):
    return emergency_fact(spark, sf_dir)


@query(
    "guarded_ratio",
    "F9 X16 X18",
    """SELECT l_orderkey, l_linenumber,
       CASE WHEN nullif(CAST(l_quantity AS BIGINT), 10) - 5 > 0
            THEN CAST(l_quantity AS BIGINT) / (nullif(CAST(l_quantity AS BIGINT), 10) - 5) END AS ratio
FROM lineitem""",
)
def guarded_ratio(spark, sf_dir):
    quantity = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", safe_ratio(quantity, F.nullif(quantity, F.lit(10)) - 5).alias("ratio")
    )
