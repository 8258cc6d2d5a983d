"""Report queries over the facts."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tallymart.operators import drilldown, latest_period, month_on_month, rank_within, region_compare, share_of_total
from tallymart.plans.contracts import WAITING_RATIO
from tallymart.sources import new_stage, save_table

from .base import WAITS_SQL, query, table
from .facts import (
    NAMED_SQL,
    PROVIDER_FACT_SQL,
    SPECIALTY_FACT_SQL,
    provider_fact,
    specialty_fact,
    with_provider_names,
)


@query(
    "month_on_month",
    "D1",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, lagged AS (
  SELECT report_month, provider_org_code, total_waiting,
         lag(total_waiting) OVER (PARTITION BY provider_org_code ORDER BY report_month) AS previous_total_waiting
  FROM fact_provider)
SELECT *, total_waiting - previous_total_waiting AS change,
  CASE WHEN total_waiting > previous_total_waiting THEN 'deteriorating'
       WHEN total_waiting < previous_total_waiting THEN 'improving'
       WHEN total_waiting = previous_total_waiting THEN 'stable' END AS trend FROM lagged""",
)
def month_on_month_(spark, sf_dir):
    fact = provider_fact(spark, sf_dir).select("report_month", "provider_org_code", "total_waiting")
    return month_on_month(fact, "provider_org_code", "total_waiting")


@query(
    "rank_percentile",
    "D2",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}
SELECT report_month, provider_org_code, over_52_weeks,
  rank() OVER w AS rank, percent_rank() OVER w AS percent_rank
FROM fact_provider WINDOW w AS (PARTITION BY report_month ORDER BY over_52_weeks DESC)""",
)
def rank_percentile(spark, sf_dir):
    fact = provider_fact(spark, sf_dir).select("report_month", "provider_org_code", "over_52_weeks")
    return rank_within(fact, "report_month", "over_52_weeks")


@query(
    "rank_of_share",
    "D2",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}
SELECT provider_org_code, report_month, within_18_weeks_pct AS pct, rank() OVER w AS rank, percent_rank() OVER w AS percent_rank
FROM fact_provider WINDOW w AS (PARTITION BY provider_org_code ORDER BY within_18_weeks_pct)""",
)
def rank_of_share(spark, sf_dir):
    fact = provider_fact(spark, sf_dir).select("provider_org_code", "report_month", F.col("within_18_weeks_pct").alias("pct"))
    return rank_within(fact, "provider_org_code", "pct", descending=False)


@query(
    "rank_narrow_values",
    "D2",
    """SELECT o_orderkey, o_orderstatus, o_orderkey + 1000000000 AS value, rank() OVER w AS rank, percent_rank() OVER w AS percent_rank
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)""",
)
def rank_narrow_values(spark, sf_dir):
    """Values that are all of one size, as they lie within a small part of their range."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") + 1_000_000_000).alias("value"))
    return rank_within(rows, "o_orderstatus", "value", descending=False)


@query(
    "share_of_total",
    "D3",
    f"""WITH {WAITS_SQL}, {SPECIALTY_FACT_SQL}, parts AS (
  SELECT report_month, treatment_function_code, CAST(sum(over_52_weeks) AS BIGINT) AS over_52_weeks
  FROM fact_specialty GROUP BY ALL),
wholes AS (SELECT report_month AS m, CAST(sum(over_52_weeks) AS BIGINT) AS whole FROM parts GROUP BY ALL)
SELECT report_month, treatment_function_code, over_52_weeks,
  CASE WHEN whole > 0 THEN over_52_weeks / whole END AS share FROM parts JOIN wholes ON m = report_month""",
)
def share_of_total_(spark, sf_dir):
    return share_of_total(specialty_fact(spark, sf_dir), "report_month", "treatment_function_code", "over_52_weeks")


def _providers(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))


@query(
    "region_compare",
    "D4 A15",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}, sums AS (
  SELECT report_month, r_name, CAST(sum(total_waiting) AS BIGINT) AS total_waiting,
         CAST(sum(within_18_weeks) AS BIGINT) AS within_18_weeks
  FROM fact_provider JOIN supplier ON s_suppkey = provider_org_code
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL)
SELECT *, CASE WHEN total_waiting > 0 THEN within_18_weeks / total_waiting END AS within_18_weeks_pct FROM sums""",
)
def region_compare_(spark, sf_dir):
    return region_compare(
        provider_fact(spark, sf_dir),
        _providers(spark, sf_dir),
        "provider_org_code",
        "s_suppkey",
        "r_name",
        ["total_waiting", "within_18_weeks"],
        WAITING_RATIO,
        group="report_month",
    )


@query(
    "latest_period",
    "D5",
    f"""WITH {WAITS_SQL}, {PROVIDER_FACT_SQL}
SELECT * FROM fact_provider WHERE report_month = (SELECT max(report_month) FROM fact_provider)""",
)
def latest_period_(spark, sf_dir):
    stored = save_table(provider_fact(spark, sf_dir), f"{new_stage(spark, 'latest')}/fact", ["report_month"])
    return latest_period(stored)


@query(
    "drilldown",
    "D6 F2 F4",
    f"""WITH {WAITS_SQL}, {SPECIALTY_FACT_SQL}
SELECT f.*, s_name AS provider_org_name, n_nationkey AS provider_parent_org_code, n_name AS provider_parent_name
FROM fact_specialty f {NAMED_SQL}
WHERE report_month BETWEEN DATE '1996-01-01' AND DATE '1999-12-01' AND treatment_function_code IN ('C_1', 'C_2')
  AND n_name = 'NATION_15'""",
)
def drilldown_(spark, sf_dir):
    star = with_provider_names(specialty_fact(spark, sf_dir), spark, sf_dir)
    return drilldown(
        star,
        {
            "report_month": (datetime.date(1996, 1, 1), datetime.date(1999, 12, 1)),
            "treatment_function_code": ["C_1", "C_2"],
            "provider_parent_name": "NATION_15",
        },
    )
