"""Query registry, table access and the shared base views.

``WAITS_SQL`` / ``waits`` shape order lines like published waiting-list rows: the order month is the
reporting month, the supplier the provider, the return flag the part type, the order priority the
treatment function, and the weeks between order and shipment the waiting band.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import month_start
from tallymart.plans.contracts import BACKLOG, CUTS, LAST_BAND


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query: the operators it exercises (by inventory id) and its SQL."""

    def wrap(run):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(run, sql, tuple(covers.split()))
        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Order lines with month, provider, part type, function and waiting band.

PART_TYPES = {"A": "Part_1", "N": "Part_2", "R": "Part_3"}


def waits(spark: SparkSession, sf_dir: str, part: str | None = None) -> DataFrame:
    """Long form: one row per order line. The part filter is applied below the join."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity", "l_shipdate"
    )
    if part:
        lines = lines.filter(F.col("l_returnflag") == part)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    days = F.abs(F.datediff("l_shipdate", "o_orderdate"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        month_start("o_orderdate").alias("report_month"),
        F.col("l_suppkey").alias("provider_org_code"),
        "l_returnflag",
        F.concat(F.lit("C_"), F.substring("o_orderpriority", 1, 1)).alias("treatment_function_code"),
        F.expr("substring(o_orderpriority, 3)").alias("treatment_function_name"),
        F.least(F.lit(LAST_BAND), F.floor(days / 7)).cast("int").alias("band"),
        F.col("l_quantity").cast("bigint").alias("pathways"),
        F.col("l_linenumber").alias("line_number"),
    )


WAITS_SQL = f"""waits AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
         l_suppkey AS provider_org_code,
         l_returnflag,
         'C_' || substr(o_orderpriority, 1, 1) AS treatment_function_code,
         substr(o_orderpriority, 3) AS treatment_function_name,
         CAST(least({LAST_BAND}, abs(date_diff('day', o_orderdate, l_shipdate)) // 7) AS INTEGER) AS band,
         CAST(l_quantity AS BIGINT) AS pathways,
         l_linenumber AS line_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def with_backlog(rows: DataFrame) -> DataFrame:
    """The six backlog measures of a long row: its own count where its band qualifies, else 0."""
    measures = {"within_18_weeks": F.col("band") < CUTS[0]}
    measures.update({f"over_{c}_weeks": F.col("band") >= c for c in CUTS})
    return rows.withColumn("total_waiting", F.col("pathways")).withColumns(
        {n: F.when(p, F.col("pathways")).otherwise(F.lit(0).cast("bigint")) for n, p in measures.items()}
    )


def backlog_sums_sql(total: str = "pathways") -> str:
    """SQL for the backlog sums over long rows."""
    tests = {"within_18_weeks": f"band < {CUTS[0]}", **{f"over_{c}_weeks": f"band >= {c}" for c in CUTS}}
    parts = [f"CAST(coalesce(sum({total}) FILTER ({tests[m]}), 0) AS BIGINT) AS {m}" for m in BACKLOG]
    return ",\n         ".join(parts)
