"""Counts and grouped sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import month_start
from tallymart.operators import (
    any_true,
    count_by,
    distinct_on,
    first_last_non_null,
    min_max_across,
    non_missing_sums,
    order,
    rows_and_distinct,
    sum_all_numeric,
)

from .base import query, table


@query(
    "count_by",
    "A1",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def count_by_(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_type")
    return count_by(events, ["day", "event_type"])


@query(
    "frequency_table",
    "A2 O2",
    """SELECT nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderstatus, count(*) AS n
FROM orders GROUP BY ALL ORDER BY n DESC, 1 NULLS LAST, 2""",
)
def frequency_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"), "o_orderstatus"
    )
    return count_by(orders, ["o_orderpriority", "o_orderstatus"], sort=True)


@query(
    "rows_and_distinct",
    "A4",
    """SELECT report_month, count(*) AS "rows",
  count(DISTINCT c) + CAST(max(CASE WHEN c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_codes
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, nullif(o_custkey, 7) AS c FROM orders)
GROUP BY ALL""",
)
def rows_and_distinct_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        month_start("o_orderdate").alias("report_month"), F.nullif(F.col("o_custkey"), F.lit(7)).alias("code")
    )
    return rows_and_distinct(orders, "report_month", "code", distinct="distinct_codes")


@query(
    "non_missing_sums",
    "A16 X14",
    """SELECT l_returnflag, l_linestatus, count(*) AS "rows", count(q) AS non_missing_quantity,
  CAST(coalesce(sum(q), 0) AS BIGINT) AS quantity_sum
FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag <> 'R' THEN nullif(CAST(l_quantity AS BIGINT), 30) END AS q
      FROM lineitem) GROUP BY ALL""",
)
def non_missing_sums_(spark, sf_dir):
    quantity = F.nullif(F.col("l_quantity").cast("bigint"), F.lit(30))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.when(F.col("l_returnflag") != "R", quantity).alias("quantity")
    )
    return non_missing_sums(lines, ["l_returnflag", "l_linestatus"], "quantity")


@query(
    "sum_all_numeric",
    "A12 P4 UD3",
    """SELECT p_type, CAST(sum(p_partkey) AS BIGINT) AS p_partkey, CAST(sum(nullif(p_size, 50)) AS BIGINT) AS p_size,
  CAST(sum(CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS price_pence FROM part GROUP BY ALL""",
)
def sum_all_numeric_(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_type",
        "p_name",
        "p_partkey",
        F.nullif(F.col("p_size"), F.lit(50)).alias("p_size"),
        F.floor(F.col("p_retailprice") * 100 + 0.5).alias("price_pence"),
    )
    return sum_all_numeric(part, "p_type")


@query(
    "min_max_across",
    "A19",
    """SELECT CAST(min(d) AS DATE) AS low, CAST(max(d) AS DATE) AS high FROM (
  SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events)""",
)
def min_max_across_(spark, sf_dir):
    dates = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return min_max_across(
        [table(spark, sf_dir, t).select(F.col(c).cast("date").alias("day")) for t, c in dates.items()], "day"
    )


_FIRST_LAST = """SELECT o_custkey,
  first(p ORDER BY o_orderdate, o_orderkey) FILTER (p IS NOT NULL) AS first_priority,
  last(p ORDER BY o_orderdate, o_orderkey) FILTER (p IS NOT NULL) AS last_priority
FROM (SELECT *, nullif(o_orderpriority, '3-MEDIUM') AS p FROM orders) GROUP BY ALL"""


@query("first_last_non_null", "A20 X15", _FIRST_LAST)
def first_last_non_null_(spark, sf_dir):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", priority.alias("first_priority"), priority.alias("last_priority")
    )
    return first_last_non_null(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], first=["first_priority"], last=["last_priority"]
    )


@query(
    "any_true",
    "A21",
    """SELECT user_id, bool_or(event_type = 'purchase') AS has_purchase, bool_or(value > 250) AS has_large
FROM events GROUP BY ALL""",
)
def any_true_(spark, sf_dir):
    return any_true(
        table(spark, sf_dir, "events"),
        "user_id",
        {"has_purchase": F.col("event_type") == "purchase", "has_large": F.col("value") > 250},
    )


@query(
    "distinct_on",
    "A22 O1",
    """SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, o_orderstatus FROM orders
ORDER BY 1, 2""",
)
def distinct_on_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("report_month", month_start("o_orderdate"))
    return order(distinct_on(orders, ["report_month", "o_orderstatus"]), "report_month", "o_orderstatus")
