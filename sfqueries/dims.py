"""Dimensions built from order, shipment and event history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import month_start
from tallymart.operators import attribute_dim, count_by, date_dim, entity_dim, stack

from .base import query, table

# Fixed value: the calendar attributes of a month d.
CALENDAR_SQL = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month,
  strftime(d, '%b %Y') AS month_year_label, 'Q' || quarter(d) AS quarter, year(d) || ' Q' || quarter(d) AS year_quarter"""


@query(
    "date_dim",
    "M1 A19 X6 X7 X8 X9 X10 X11",
    f"""WITH bounds AS (SELECT min(m) AS lo, max(m) AS hi FROM (
  SELECT date_trunc('month', o_orderdate) AS m FROM orders
  UNION ALL SELECT date_trunc('month', l_shipdate) FROM lineitem
  UNION ALL SELECT date_trunc('month', ts) FROM events))
SELECT d AS report_month, {CALENDAR_SQL}
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d FROM bounds)""",
)
def date_dim_(spark, sf_dir):
    dates = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return date_dim([table(spark, sf_dir, t).select(month_start(c).alias("report_month")) for t, c in dates.items()])


# Order rows are the first source, line rows the second. An entity is a customer; its name there is
# the order priority or the ship mode flag pair, its parent the order status or the line status.

_HISTORY_SQL = """history AS (
  SELECT 1 AS source_rank, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
         nullif(o_custkey, 3) AS code, nullif(o_orderpriority, '5-LOW') AS name,
         CAST(NULL AS VARCHAR) AS parent_code, o_orderstatus AS parent_name
  FROM orders
  UNION ALL
  SELECT 2, CAST(date_trunc('month', l_shipdate) AS DATE), nullif(l_suppkey, 3), nullif(l_returnflag, 'N'),
         nullif('P' || l_linenumber, 'P1'), nullif(l_linestatus, 'O')
  FROM lineitem)"""
_PLACE = "source_rank, report_month NULLS LAST, parent_code NULLS LAST, parent_name NULLS LAST, name NULLS LAST"


@query(
    "entity_dim",
    "M2 A20 A21 U1 P7 F6 X15",
    f"""WITH {_HISTORY_SQL}
SELECT code,
  last(name ORDER BY {_PLACE}) FILTER (name IS NOT NULL) AS name,
  first(parent_code ORDER BY {_PLACE}) FILTER (parent_code IS NOT NULL) AS parent_code,
  last(parent_name ORDER BY {_PLACE}) FILTER (parent_name IS NOT NULL) AS parent_name,
  bool_or(source_rank = 1) AS appears_in_orders, bool_or(source_rank = 2) AS appears_in_lines
FROM history WHERE code IS NOT NULL GROUP BY ALL""",
)
def entity_dim_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.lit(1).alias("source_rank"),
        month_start("o_orderdate").alias("report_month"),
        F.nullif(F.col("o_custkey"), F.lit(3)).alias("code"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("name"),
        F.lit(None).cast("string").alias("parent_code"),
        F.col("o_orderstatus").alias("parent_name"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit(2).alias("source_rank"),
        month_start("l_shipdate").alias("report_month"),
        F.nullif(F.col("l_suppkey"), F.lit(3)).alias("code"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("name"),
        F.nullif(F.concat(F.lit("P"), F.col("l_linenumber").cast("string")), F.lit("P1")).alias("parent_code"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("parent_name"),
    )
    return entity_dim(
        stack(orders, lines),
        "code",
        source="source_rank",
        period="report_month",
        last=["name", "parent_name"],
        first=["parent_code"],
        tie_break=["parent_code", "parent_name"],
        flags={"appears_in_orders": F.col("source_rank") == 1, "appears_in_lines": F.col("source_rank") == 2},
    )


@query(
    "attribute_dim",
    "M3 A22 F6 O1",
    """SELECT DISTINCT code, p_name AS name FROM (SELECT CASE p_type WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN NULL
  ELSE p_type || ' ' || p_brand END AS code, p_name FROM part) WHERE code <> '' ORDER BY name, code""",
)
def attribute_dim_(spark, sf_dir):
    kind = F.col("p_type")
    code = F.when(kind == "SMALL", "").when(kind != "LARGE", F.concat_ws(" ", kind, "p_brand"))
    return attribute_dim(table(spark, sf_dir, "part").select(code.alias("code"), F.col("p_name").alias("name")), "code", "name")


@query(
    "facts_per_month",
    "M1 X11 J1",
    """WITH bounds AS (SELECT min(m) AS lo, max(m) AS hi FROM (
  SELECT date_trunc('month', l_shipdate) AS m FROM lineitem UNION ALL SELECT date_trunc('month', ts) FROM events)),
spine AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d FROM bounds),
per_month AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT d AS report_month, coalesce(n, 0) AS lines FROM spine LEFT JOIN per_month ON m = d""",
)
def facts_per_month(spark, sf_dir):
    """Line counts on the month spine: months without lines stay, with 0."""
    lines = table(spark, sf_dir, "lineitem").select(month_start("l_shipdate").alias("report_month"))
    events = table(spark, sf_dir, "events").select(month_start("ts").alias("report_month"))
    spine = date_dim([lines, events]).select("report_month")
    return spine.join(count_by(lines, "report_month", "lines"), "report_month", "left").fillna(0, ["lines"])
