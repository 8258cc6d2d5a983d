"""Row filters, projection, names, text and months."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import (
    base_name,
    calendar_columns,
    clean_names,
    columns_matching,
    columns_of_type,
    missing_text,
    parse_month,
    strip_prefix,
    with_measures,
)
from tallymart.operators import count_by, drop_totals, first_n, order, stack, sum_all_numeric, valid_key

from .base import query, table

_LABELLED_SQL = """labelled AS (
  SELECT o_orderkey, nullif(CASE o_orderpriority WHEN '1-URGENT' THEN 'Total' WHEN '2-HIGH' THEN 'TOTAL'
    WHEN '3-MEDIUM' THEN 'total' ELSE o_orderpriority END, '5-LOW') AS period FROM orders)"""


def _labelled(spark, sf_dir):
    priority = F.col("o_orderpriority")
    spelled = (
        F.when(priority == "1-URGENT", "Total")
        .when(priority == "2-HIGH", "TOTAL")
        .when(priority == "3-MEDIUM", "total")
        .otherwise(priority)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(spelled, F.lit("5-LOW")).alias("period"))


@query("drop_totals", "F1 X1", f"WITH {_LABELLED_SQL} SELECT * FROM labelled WHERE upper(period) <> 'TOTAL'")
def drop_totals_(spark, sf_dir):
    return drop_totals(_labelled(spark, sf_dir), "period")


@query("keep_totals", "F1 X1", f"WITH {_LABELLED_SQL} SELECT * FROM labelled WHERE upper(period) = 'TOTAL'")
def keep_totals(spark, sf_dir):
    return drop_totals(_labelled(spark, sf_dir), "period", keep=True)


@query(
    "in_list",
    "F4 F2 P3 O1",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM') ORDER BY o_orderdate, o_orderkey""",
)
def in_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"))
    chosen = orders.filter(F.col("o_orderstatus") == "P").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    return order(chosen, "o_orderdate", "o_orderkey")


@query(
    "valid_key",
    "F6 X14",
    """SELECT doc_id, k FROM (SELECT doc_id, CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN NULL ELSE lang END AS k
FROM documents) WHERE k IS NOT NULL AND k <> ''""",
)
def valid_key_(spark, sf_dir):
    lang = F.col("lang")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(lang == "fr", "").when(lang != "de", lang).alias("k")
    )
    return valid_key(documents, "k")


@query(
    "parse_month",
    "X1 X2 X5 X6",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END
  AS report_month FROM orders""",
)
def parse_month_(spark, sf_dir):
    """Order months written out in several spellings, and one that is no month, read back."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.concat(F.lit("RTT-"), F.date_format(day, "MMMM-yyyy")))
        .when(priority == "2-HIGH", F.concat(F.lit("RTT-"), F.upper(F.date_format(day, "MMMM-yyyy"))))
        .when(priority == "3-MEDIUM", F.concat(F.lit("RTT-"), F.date_format(day, "MMM-yyyy")))
        .when(priority == "5-LOW", F.lit("RTT-zz"))
        .otherwise(F.date_format(day, "MMMM yyyy"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_month(text, "RTT-").alias("report_month"))


@query(
    "strip_prefix",
    "X2 X3 X4",
    """SELECT p_partkey, regexp_replace(p_brand, '^Brand#', '') AS brand,
  CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER) AS brand_number,
  regexp_matches(p_name, '(?i)RING') AS is_ring FROM part""",
)
def strip_prefix_(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        strip_prefix("p_brand", "Brand#").alias("brand"),
        F.regexp_extract("p_brand", r"#(\d+)$", 1).cast("int").alias("brand_number"),
        F.col("p_name").rlike("(?i)RING").alias("is_ring"),
    )


@query(
    "calendar_columns",
    "X7 X8 X9 X10 X12",
    """SELECT o_orderkey, d AS report_month, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month,
  strftime(d, '%b %Y') AS month_year_label, 'Q' || quarter(d) AS quarter, year(d) || ' Q' || quarter(d) AS year_quarter
FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)""",
)
def calendar_columns_(spark, sf_dir):
    # The date goes through text, as it does in a CSV hand-off.
    text = F.date_format("o_orderdate", "yyyy-MM-01")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date(text).alias("report_month"))
    return orders.withColumns(calendar_columns("report_month"))


@query(
    "missing_text",
    "S5 X14 X16",
    """SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN NULL ELSE event_type END AS kind
FROM events""",
)
def missing_text_(spark, sf_dir):
    kind = F.col("event_type")
    padded = F.when(kind == "view", "  ").when(kind == "error", "NA").otherwise(F.concat(F.lit(" "), kind, F.lit("  ")))
    return table(spark, sf_dir, "events").select("event_id", missing_text(padded).alias("kind"))


@query(
    "base_name",
    "X19",
    """SELECT page_id, list_extract(string_split(url, '/'), -1) AS base_name FROM pages""",
)
def base_name_(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", base_name("url").alias("base_name"))


@query(
    "clean_names",
    "P1 P4 P5",
    """SELECT o_orderpriority AS treatment_function, CAST(sum(CAST(o_totalprice > 250000 AS BIGINT)) AS BIGINT)
    AS gt_00_to_01_weeks_sum_1, CAST(count(*) AS BIGINT) AS a_e_attendances, CAST(sum(o_custkey) AS BIGINT) AS total,
  CAST(sum(o_orderkey) AS BIGINT) AS total_2 FROM orders GROUP BY ALL""",
)
def clean_names_(spark, sf_dir):
    """Messy headers are cleaned, then every numeric column found by type is summed."""
    messy = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Treatment Function"),
        (F.col("o_totalprice") > 250000).cast("bigint").alias("Gt 00 To 01 Weeks SUM 1"),
        F.lit(1).cast("bigint").alias("A&E attendances"),
        F.col("o_custkey").alias("Total"),
        F.col("o_orderkey").alias("Total."),
    )
    clean = clean_names(messy)
    assert columns_matching(clean, "WEEK|ATTEND") == columns_of_type(clean, "numeric")[:2]
    return sum_all_numeric(clean, "treatment_function")


@query(
    "sequential_measures",
    "P2 P3 P8 R5 X18",
    """SELECT l_orderkey, l_linenumber AS line, q AS units, q + 1 AS padded, 2 * (q + 1) AS doubled,
  2 * (q + 1) - q AS net FROM (SELECT *, nullif(CAST(l_quantity AS BIGINT), 20) AS q FROM lineitem)""",
)
def sequential_measures(spark, sf_dir):
    quantity = F.nullif(F.col("l_quantity").cast("bigint"), F.lit(20))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("l_quantity"))
    renamed = lines.withColumnsRenamed({"l_linenumber": "line", "l_quantity": "units"})
    return with_measures(
        renamed,
        {
            "padded": F.col("units") + 1,
            "doubled": 2 * F.col("padded"),
            "net": F.col("doubled") - F.col("units"),
        },
    )


@query(
    "first_n",
    "O2 O3",
    """SELECT l_orderkey, l_linenumber, p FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  nullif(l_quantity, 50) AS p FROM lineitem)
ORDER BY p DESC NULLS LAST, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50""",
)
def first_n_(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("p", F.nullif(F.col("l_quantity"), F.lit(50.0)))
    top = first_n(lines, 50, "-p", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return top.select("l_orderkey", "l_linenumber", "p")


@query(
    "stack",
    "U1 P7 S8",
    """SELECT code, name, parent, source, count(*) AS n FROM (
  SELECT s_nationkey AS code, s_name AS name, CAST(NULL AS VARCHAR) AS parent, 'A' AS source FROM supplier
  UNION ALL SELECT c_nationkey, c_name, c_mktsegment, 'B' FROM customer) GROUP BY ALL""",
)
def stack_(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("code"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("parent"),
        F.lit("A").alias("source"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit("B").alias("source"),
        F.col("c_mktsegment").alias("parent"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("code"),
    )
    return count_by(stack(suppliers, customers), ["code", "name", "parent", "source"])
