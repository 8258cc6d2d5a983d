"""Keys, ranges and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import month_start
from tallymart.operators import (
    conflicting_attributes,
    drop_totals,
    duplicate_keys,
    foreign_key_check,
    grain_reconciliation,
    issue_count,
    match_tally,
    missing_keys,
    band_reconciliation,
    published_total_check,
    qa_summary,
    range_check,
    reconciliation_summary,
    sanity_counts,
    stack,
    status_tally,
    unique_key_check,
)
from tallymart.plans.contracts import ALL_FUNCTIONS, COMPARED

from .base import WAITS_SQL, query, table
from .facts import (
    EMERGENCY_SQL,
    GRAIN,
    PROVIDER_FACT_SQL,
    SPECIALTY_FACT_SQL,
    emergency_fact,
    provider_fact,
    provider_fact_of,
    specialty_fact_of,
    staged_totals,
)
def both_facts(spark, sf_dir):
    """The provider fact, and a specialty fact that lacks the unspecified function.

    The unspecified function gets no code, and excluding a code drops rows without one.
    """
    totals = staged_totals(spark, sf_dir)
    code = F.nullif(F.col("treatment_function_code"), F.lit("C_4"))
    return provider_fact_of(totals), specialty_fact_of(totals.withColumn("treatment_function_code", code))


_FINE_SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS fine_{m}" for m in COMPARED)
_DIFFS = ", ".join(f"{m}, fine_{m}, {m} - fine_{m} AS {m}_difference" for m in COMPARED)
GRAIN_SQL = f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, {SPECIALTY_FACT_SQL}, fine AS (
  SELECT report_month, provider_org_code, {_FINE_SUMS}
  FROM fact_specialty WHERE nullif(treatment_function_code, 'C_4') <> '{ALL_FUNCTIONS}' GROUP BY ALL),
diffs AS (
  SELECT p.report_month, p.provider_org_code, {_DIFFS}
  FROM fact_provider p LEFT JOIN fine f
    ON p.report_month IS NOT DISTINCT FROM f.report_month
   AND p.provider_org_code IS NOT DISTINCT FROM f.provider_org_code)"""


def differences(spark, sf_dir):
    return grain_reconciliation(*both_facts(spark, sf_dir), GRAIN, list(COMPARED))


@query("grain_reconciliation", "V3 A14 J2 R5 S13", f"{GRAIN_SQL} SELECT * FROM diffs")
def grain_reconciliation_(spark, sf_dir):
    return differences(spark, sf_dir)


@query(
    "reconciliation_summary",
    "V3 A18 X17",
    f"""{GRAIN_SQL}
SELECT count(*) AS provider_month_rows,
       CAST(count_if(total_waiting_difference = 0) AS BIGINT) AS exact_matches,
       CAST(count_if(total_waiting_difference <> 0) AS BIGINT) AS mismatches,
       max(abs(total_waiting_difference)) AS max_absolute_difference,
       CAST(count_if(total_waiting_difference IS NULL) AS BIGINT) AS unmatched
FROM diffs""",
)
def reconciliation_summary_(spark, sf_dir):
    return reconciliation_summary(
        differences(spark, sf_dir), "total_waiting_difference", rows="provider_month_rows", unmatched="unmatched"
    )


# Lines as provider rows of three published files, with a TOTAL row per file that is one unit off
# for quantity in the first file and leaves out the tax units.


def published_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source_file"),
        F.col("l_linestatus").alias("period"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("price_pence"),
        F.floor(F.col("l_tax") * 100 + 0.5).alias("tax_points"),
    )
    totals = lines.groupBy("source_file").agg(
        F.lit("Total").alias("period"),
        (F.sum("quantity") + F.when(F.col("source_file") == "A", 1).otherwise(0)).alias("quantity"),
        F.sum("price_pence").alias("price_pence"),
        F.lit(None).cast("bigint").alias("tax_points"),
    )
    return stack(lines, totals)


def totals_check(spark, sf_dir):
    rows = published_lines(spark, sf_dir)
    return published_total_check(drop_totals(rows, "period"), drop_totals(rows, "period", keep=True), "source_file")


_METRICS = {
    "quantity": ("CAST(l_quantity AS BIGINT)", "+ CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END"),
    "price_pence": ("CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)", ""),
    "tax_points": ("CAST(floor(l_tax * 100 + 0.5) AS BIGINT)", "+ NULL"),
}
TOTALS_SQL = "checked AS (" + " UNION ALL ".join(
    f"""SELECT l_returnflag AS source_file, '{m}' AS metric,
  CAST(sum({e}) AS BIGINT) AS calculated_total, CAST(sum({e}) {off} AS BIGINT) AS published_total
  FROM lineitem GROUP BY l_returnflag"""
    for m, (e, off) in _METRICS.items()
) + ")"


@query(
    "published_total_check",
    "V1 A12 R2 J1 F1",
    f"""WITH {TOTALS_SQL} SELECT *, calculated_total - published_total AS difference,
  calculated_total = published_total AS matches FROM checked""",
)
def published_total_check_(spark, sf_dir):
    return totals_check(spark, sf_dir)


_DECIMAL_TOTALS = {"price_decimal": "decimal", "price_double": "double"}


@query(
    "published_total_decimal",
    "V1 A12 R2",
    """WITH sums AS (SELECT l_returnflag AS source_file, sum(CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2))) AS total
  FROM lineitem GROUP BY ALL), checked AS (
  SELECT source_file, unnest(['price_decimal', 'price_double']) AS metric, total AS calculated,
         total + CASE WHEN source_file = 'A' THEN CAST(0.01 AS DECIMAL(18, 2)) ELSE 0 END AS published FROM sums)
SELECT source_file, metric, CAST(calculated AS DOUBLE) AS calculated_total, CAST(published AS DOUBLE) AS published_total,
  CAST(calculated - published AS DOUBLE) AS difference, calculated = published AS matches FROM checked""",
)
def published_total_decimal(spark, sf_dir):
    """Prices with pence, as decimals and as doubles; one file's published total is a penny off."""
    price = F.round("l_extendedprice", 2)
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source_file"), price.cast("decimal(18,2)").alias("price_decimal"), price.alias("price_double")
    )
    exact = rows.groupBy("source_file").agg(F.sum("price_decimal").alias("total"))
    exact = exact.withColumn("total", F.col("total") + F.when(F.col("source_file") == "A", F.lit(0.01).cast("decimal(18,2)")).otherwise(0))
    totals = exact.select("source_file", *[F.col("total").cast("decimal(18,2)" if t == "decimal" else t).alias(c) for c, t in _DECIMAL_TOTALS.items()])
    checked = published_total_check(rows, totals, "source_file")
    return checked.withColumns({c: F.col(c).cast("double") for c in ("calculated_total", "published_total", "difference")})


@query(
    "band_reconciliation_decimal",
    "V2 R5",
    """WITH parts AS (SELECT l_orderkey % 10 AS pence, l_linenumber AS n FROM lineitem)
SELECT count(*) AS "rows", CAST(count_if(n <> 7) AS BIGINT) AS total_matches, CAST(count_if(n = 7) AS BIGINT) AS total_mismatches FROM parts""",
)
def band_reconciliation_decimal(spark, sf_dir):
    """Parts of 0.1 and 0.2 and the like as doubles; the total is as published, but for seventh lines."""
    pence = (F.col("l_orderkey") % 10).cast("decimal(9,1)") / 10
    rows = table(spark, sf_dir, "lineitem").select(
        pence.cast("double").alias("one"), F.lit(0.2).alias("two"),
        (pence + F.lit(0.2).cast("decimal(9,1)") + (F.col("l_linenumber") == 7).cast("int")).cast("decimal(9,1)").cast("double").alias("total"),
    )
    return band_reconciliation(rows, ["one", "two"], "total")


@query(
    "match_tally",
    "A26 V1",
    f"WITH {TOTALS_SQL} SELECT calculated_total = published_total AS matches, count(*) AS n FROM checked GROUP BY ALL",
)
def match_tally_(spark, sf_dir):
    return match_tally(totals_check(spark, sf_dir))


@query(
    "total_mismatches",
    "F7 V1",
    f"""WITH {TOTALS_SQL} SELECT source_file, metric, calculated_total - published_total AS difference
FROM checked WHERE NOT (calculated_total = published_total)""",
)
def total_mismatches(spark, sf_dir):
    return totals_check(spark, sf_dir).filter(~F.col("matches")).select("source_file", "metric", "difference")


@query(
    "duplicate_keys",
    "A3 F8",
    """SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, count(*) AS n
FROM orders GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", month_start("o_orderdate").alias("report_month"))
    return duplicate_keys(orders, ["o_custkey", "report_month"])


@query(
    "conflicting_attributes",
    "A5 A22",
    """SELECT p_name, count(*) AS name_count
FROM (SELECT DISTINCT p_name, nullif(p_brand, 'Brand#7') FROM part) GROUP BY ALL HAVING count(*) > 1""",
)
def conflicting_attributes_(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_brand", F.nullif(F.col("p_brand"), F.lit("Brand#7")))
    return conflicting_attributes(part, "p_name", "p_brand")


# Orders against the customers of one market segment, so that many keys are absent.


def _household(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")


@query(
    "foreign_key_same_name",
    "V4 J3",
    """SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey NOT IN
 (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000)""",
)
def foreign_key_same_name(spark, sf_dir):
    dim = _household(spark, sf_dir).filter(F.col("c_acctbal") > 9000)
    dim = dim.withColumnRenamed("c_nationkey", "n_nationkey")
    return missing_keys(table(spark, sf_dir, "nation"), dim, "n_nationkey", unique=False)


@query(
    "foreign_key_renamed",
    "V4 J4",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
 (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""",
)
def foreign_key_renamed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return missing_keys(orders, _household(spark, sf_dir), "o_custkey", "c_custkey")


_NULL_DIM = "SELECT nullif(c_mktsegment, 'BUILDING') AS k FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')"


@query(
    "foreign_key_null_safe",
    "V4 J4 A25",
    f"""WITH dim AS ({_NULL_DIM}), fact AS (SELECT nullif(c_mktsegment, 'BUILDING') AS s FROM customer)
SELECT 'segment, missing matches missing' AS "check", count(*) AS issue_count FROM fact
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE k IS NOT DISTINCT FROM s)
UNION ALL SELECT 'segment, missing never matches', count(*) FROM fact
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE k = s)""",
)
def foreign_key_null_safe(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    dim = customer.filter(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(F.col("segment").alias("k"))
    return stack(
        foreign_key_check("segment, missing matches missing", customer, dim, "segment", "k", unique=False),
        foreign_key_check("segment, missing never matches", customer, dim, "segment", "k", null_safe=False, unique=False),
    )


_RULES = {
    "negative quantity left": "l_quantity - 25 < 0",
    "discount above 8 percent": "l_discount > 0.08",
    "no tax": "nullif(l_tax, 0.05) <= 0",
    "shipped before 1996": "l_shipdate < TIMESTAMP '1996-01-01 00:00:00'",
}


@query(
    "range_checks",
    "V6 A17",
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", CAST(count_if({p}) AS BIGINT) AS issue_count FROM lineitem" for n, p in _RULES.items()
    ),
)
def range_checks(spark, sf_dir):
    rules = {n: F.expr(p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")) for n, p in _RULES.items()}
    return range_check(table(spark, sf_dir, "lineitem"), rules)


@query(
    "ae_sanity",
    "A17 X14",
    f"""WITH {EMERGENCY_SQL}
SELECT count(*) AS "rows",
       CAST(count_if(total_attendances IS NULL) AS BIGINT) AS missing_total,
       CAST(count_if(within_4_hours < 0) AS BIGINT) AS negative_within_4,
       CAST(count_if(ae_4_hour_performance_pct < 0.4) AS BIGINT) AS performance_below_40,
       min(ae_4_hour_performance_pct) AS min_ae_4_hour_performance_pct,
       max(ae_4_hour_performance_pct) AS max_ae_4_hour_performance_pct
FROM fact_ae""",
)
def ae_sanity(spark, sf_dir):
    return sanity_counts(
        emergency_fact(spark, sf_dir),
        {
            "missing_total": F.col("total_attendances").isNull(),
            "negative_within_4": F.col("within_4_hours") < 0,
            "performance_below_40": F.col("ae_4_hour_performance_pct") < 0.4,
        },
        ranges=["ae_4_hour_performance_pct"],
    )


# A QA summary in which some checks must fail.

_QA = ["Orders duplicate keys", "Orders duplicate customer months", "Customers without orders", "Lines without order",
       "Share below 0", "Share above 1", "Share is 1"]

_QA_SQL = f"""qa AS (
  SELECT "check", CAST(issue_count AS BIGINT) AS issue_count,
         CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM (
    SELECT '{_QA[0]}' AS "check", count(*) AS issue_count
      FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT '{_QA[1]}', count(*) FROM (
      SELECT o_custkey, date_trunc('month', o_orderdate) FROM orders GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT '{_QA[2]}', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT '{_QA[3]}', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT '{_QA[4]}', count_if(within_18_weeks_pct < 0) FROM fact_provider
    UNION ALL SELECT '{_QA[5]}', count_if(within_18_weeks_pct > 1) FROM fact_provider
    UNION ALL SELECT '{_QA[6]}', count_if(within_18_weeks_pct = 1) FROM fact_provider))"""


def qa(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    months = orders.select("o_custkey", month_start("o_orderdate").alias("report_month"))
    share = F.col("within_18_weeks_pct")
    checks = [
        unique_key_check(_QA[0], orders, "o_orderkey"),
        unique_key_check(_QA[1], months, ["o_custkey", "report_month"]),
        issue_count(_QA[2], missing_keys(customers, orders, "c_custkey", "o_custkey", unique=False)),
        foreign_key_check(_QA[3], table(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey"),
        range_check(provider_fact(spark, sf_dir), {_QA[4]: share < 0, _QA[5]: share > 1, _QA[6]: share == 1}),
    ]
    return qa_summary(checks, _QA)


@query("qa_summary", "V4 V5 V6 V7 A25 X16", f"WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, {_QA_SQL} SELECT * FROM qa")
def qa_summary_(spark, sf_dir):
    return qa(spark, sf_dir)


@query(
    "status_tally",
    "A27",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, {_QA_SQL}
SELECT count(*) AS checks, CAST(count_if(status = 'PASS') AS BIGINT) AS passed,
       CAST(count_if(status <> 'PASS') AS BIGINT) AS review, bool_and(status = 'PASS') AS all_passed FROM qa""",
)
def status_tally_(spark, sf_dir):
    return status_tally(qa(spark, sf_dir))
