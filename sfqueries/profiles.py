"""Column profiles of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.functions import columns_except, columns_of_type, likely_fields
from tallymart.operators import (
    any_text_equals,
    character_profile,
    dataset_overview,
    exact_duplicates,
    missing_profile,
    numeric_profile,
    profile_report,
    stack,
    stats_to_long,
    table_counts,
    type_profile,
    wide_to_long,
)

from tallymart.operators.profile import write_report
from tallymart.sources import new_stage, read_csv, read_headers, save_table, write_csv

from .base import query, table

# Values treated as missing, so that profiles have something to find.
GAPS = {
    "l_quantity": "10",
    "l_discount": "0.05",
    "l_returnflag": "'R'",
    "l_linestatus": "'O'",
}
LINE_COLUMNS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def gap(name: str) -> str:
    """The column with its planted gap; adding 0 also folds negative zero into zero."""
    plain = f"{name} + 0" if LINE_COLUMNS.get(name) == "double" else name
    return f"nullif({plain}, {GAPS[name]})" if name in GAPS else plain


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{gap(c)} AS {c}" for c in LINE_COLUMNS])


def missing_sql(name: str) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) - count({gap(name)}) AS missing_count,
  round_even((count(*) - count({gap(name)})) / count(*) * 100, 2) AS missing_pct FROM lineitem"""


@query("missing_profile", "A7 R1 X13 X14", " UNION ALL ".join(map(missing_sql, LINE_COLUMNS)))
def missing_profile_(spark, sf_dir):
    return missing_profile(lines(spark, sf_dir))


NUMERIC = [c for c, t in LINE_COLUMNS.items() if t in ("bigint", "int", "double")]


def numeric_sql(name: str, source: str, expr: str, dtype: str) -> str:
    return f"""SELECT '{name}' AS metric, min(CAST({expr} AS {dtype})) AS min, max(CAST({expr} AS {dtype})) AS max,
  CAST(count_if({expr} = 0) AS BIGINT) AS zero_count,
  CAST(count_if({expr} < 0) AS BIGINT) AS negative_count FROM {source}"""


@query(
    "numeric_profile",
    "A8 R2 P4 P6",
    " UNION ALL ".join(numeric_sql(c, "lineitem", gap(c), "DOUBLE") for c in NUMERIC),
)
def numeric_profile_(spark, sf_dir):
    return numeric_profile(lines(spark, sf_dir))


_ORDER_NUMBERS = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "pounds": "CAST(floor(o_totalprice) AS BIGINT) - 250000"}


@query(
    "stats_to_long",
    "R3 UD3",
    " UNION ALL ".join(numeric_sql(c, "orders", e, "BIGINT") for c, e in _ORDER_NUMBERS.items()),
)
def stats_to_long_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _ORDER_NUMBERS.items()])
    return stats_to_long(
        orders,
        columns_of_type(orders, "numeric"),
        {
            "min": F.min,
            "max": F.max,
            "zero_count": lambda c: F.count_if(c == 0),
            "negative_count": lambda c: F.count_if(c < 0),
        },
    )


_TEXT = {
    "documents": ["text", "lang", "source"],
    "lineitem": ["l_returnflag", "l_linestatus"],
}


def _distinct_sql(name: str, expr: str, source: str) -> str:
    return f"""SELECT '{name}' AS column_name,
  count(DISTINCT {expr}) + CAST(max(CASE WHEN {expr} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_values
FROM {source}"""


@query("character_profile", "A9 R1 P4", " UNION ALL ".join(_distinct_sql(c, gap(c), "lineitem") for c in _TEXT["lineitem"]))
def character_profile_(spark, sf_dir):
    return character_profile(lines(spark, sf_dir))


@query(
    "character_profile_texts",
    "A9",
    " UNION ALL ".join(
        _distinct_sql(c, "nullif(lang, 'de')" if c == "lang" else c, "documents") for c in _TEXT["documents"]
    ),
)
def character_profile_texts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))
    return character_profile(documents)


_LABELS = {"bigint": "numeric", "int": "numeric", "double": "numeric", "string": "character", "timestamp_ntz": "POSIXct"}


@query(
    "type_profile",
    "A10 X20 UD4",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{_LABELS[t]}' AS data_type, count({gap(c)}) AS present FROM lineitem"
        for c, t in LINE_COLUMNS.items()
    ),
)
def type_profile_(spark, sf_dir):
    """Types next to how many values each column holds."""
    df = lines(spark, sf_dir)
    present = wide_to_long(df.agg(*[F.count(c).alias(c) for c in df.columns]), "column_name", "present")
    return type_profile(df).join(present, "column_name")


@query(
    "wide_to_long",
    "R2 P6",
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS metric, CAST({e} AS BIGINT) AS value FROM orders"
        for c, e in {"o_custkey": "o_custkey", "pounds": "nullif(CAST(floor(o_totalprice) AS BIGINT), 250000)"}.items()
    ),
)
def wide_to_long_(spark, sf_dir):
    pounds = F.nullif(F.floor("o_totalprice"), F.lit(250000).cast("bigint"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", pounds.alias("pounds"))
    assert columns_except(orders, "o_orderkey") == ["o_custkey", "pounds"]
    return wide_to_long(orders, "metric", "value", ids=["o_orderkey"], dtype="bigint")


@query(
    "exact_duplicates",
    "A11",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS exact_duplicates FROM (
  SELECT l_suppkey, l_linenumber, nullif(l_returnflag, 'R') AS f, l_linestatus, l_shipdate, count(*) AS n
  FROM lineitem GROUP BY ALL)""",
)
def exact_duplicates_(spark, sf_dir):
    return exact_duplicates(
        lines(spark, sf_dir).select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    )


@query(
    "exact_duplicate_rows",
    "A11",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS exact_duplicates FROM (
  SELECT user_id, event_type, floor(value), ts, count(*) AS n FROM (
    SELECT user_id, event_type, CASE WHEN value > 100 THEN NULL ELSE value END AS value, date_trunc('hour', ts) AS ts
    FROM events) GROUP BY ALL)""",
)
def exact_duplicate_rows(spark, sf_dir):
    value = F.floor(F.when(F.col("value") <= 100, F.col("value"))).cast("double")
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", value.alias("value"), F.date_trunc("hour", "ts").alias("ts")
    )
    return exact_duplicates(events, digest=True)


@query(
    "exact_duplicate_texts",
    "A11",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS exact_duplicates FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)",
)
def exact_duplicate_texts(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"), ["text"], digest=True)


@query(
    "any_total_row",
    "F5 U1",
    """SELECT CAST(NULL AS INTEGER) AS n_nationkey, 'Total' AS n_name, CAST(count(*) AS BIGINT) AS customers
FROM customer
UNION ALL SELECT CAST(n AS INTEGER), 'TOTAL', c FROM (
  SELECT c_nationkey AS n, count(*) AS c FROM customer GROUP BY ALL) WHERE n = 7""",
)
def any_total_row(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    count = F.count(F.lit(1)).alias("customers")
    per_nation = customers.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(count)
    label = F.when(F.col("n_nationkey") == 7, "TOTAL").otherwise("nation")
    total_row = customers.agg(F.lit(None).cast("int").alias("n_nationkey"), F.lit("Total").alias("n_name"), count)
    return any_text_equals(stack(per_nation.select("n_nationkey", label.alias("n_name"), "customers"), total_row))


@query(
    "dataset_overview",
    "A23",
    """SELECT count(*) AS total_rows, 5 AS total_columns, count(DISTINCT source) AS source_files FROM documents""",
)
def dataset_overview_(spark, sf_dir):
    return dataset_overview(table(spark, sf_dir, "documents"), "source")


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(
    "table_counts",
    "A24 S12",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def table_counts_(spark, sf_dir):
    return table_counts({t: table(spark, sf_dir, t) for t in TABLES})


def _row_sql(name: str) -> str:
    dtype = LINE_COLUMNS[name]
    numeric, text = name in NUMERIC, dtype == "string"
    e = f"CAST({gap(name)} AS DOUBLE)"
    return f"""SELECT '{name}' AS column_name,
  '{"numeric" if numeric else "character" if text else "Date"}' AS data_type,
  count(*) - count({gap(name)}) AS missing_count,
  round_even((count(*) - count({gap(name)})) / count(*) * 100, 2) AS missing_pct,
  {f"min({e})" if numeric else "CAST(NULL AS DOUBLE)"} AS min, {f"max({e})" if numeric else "CAST(NULL AS DOUBLE)"} AS max,
  {f"CAST(count_if({e} = 0) AS BIGINT)" if numeric else "CAST(NULL AS BIGINT)"} AS zero_count,
  {f"count(DISTINCT {gap(name)}) + CAST(max(CAST({gap(name)} IS NULL AS BIGINT)) AS BIGINT)" if text else "CAST(NULL AS BIGINT)"}
    AS distinct_values, TRUE AS in_every_file FROM lineitem"""


@query("profile_report", "V8 S7 S10 A6 A7 A8 A9 A10", " UNION ALL ".join(map(_row_sql, LINE_COLUMNS)))
def profile_report_(spark, sf_dir):
    """Lines go out as CSV, come back through the header check, and are profiled; the written
    reports are then put side by side, one row per column."""
    stage = new_stage(spark, "profile")
    rows = lines(spark, sf_dir).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    write_csv(rows, f"{stage}/raw")
    back = save_table(read_csv(spark, f"{stage}/raw", rows.schema), f"{stage}/rows")
    write_report(profile_report(back, read_headers(spark, f"{stage}/raw")), f"{stage}/reports")

    def report(name, schema):
        parsed = StructType.fromDDL(schema)
        return read_csv(spark, f"{stage}/reports/{name}.csv", parsed, lineage=None)

    files = report("column_counts", "file string, column_count bigint").agg(F.count(F.lit(1)).alias("files"))
    present = report("schema_check", "column_name string, files_present bigint")
    present = present.join(files, F.col("files_present") == F.col("files"), "left")
    return (
        report("type_profile", "column_name string, data_type string")
        .join(report("missing_profile", "column_name string, missing_count bigint, missing_pct double"), "column_name")
        .join(
            report("numeric_profile", "metric string, min double, max double, zero_count bigint").withColumnRenamed(
                "metric", "column_name"
            ),
            "column_name",
            "left",
        )
        .join(report("character_profile", "column_name string, distinct_values bigint"), "column_name", "left")
        .join(present, "column_name")
        .withColumn("in_every_file", F.col("files").isNotNull())
        .drop("files_present", "files")
    )


_FIELDS = {"date": "date", "key": "key$", "amount": "price|discount|tax"}
_FOUND = {"date": ["l_shipdate"], "key": ["l_orderkey", "l_partkey", "l_suppkey"], "amount": ["l_extendedprice", "l_discount", "l_tax"]}


@query(
    "likely_fields",
    "P5 UD1",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS column_name, count({c}) AS present FROM lineitem" for kind, names in _FOUND.items() for c in names
    ),
)
def likely_fields_(spark, sf_dir):
    """Columns found by what their names look like, with their values counted in one pass."""
    lines = table(spark, sf_dir, "lineitem")
    found = [(kind, c) for kind, names in likely_fields(lines, _FIELDS).items() for c in names]
    counts = lines.agg(*[F.count(c).alias(c) for c in dict.fromkeys(c for _, c in found)])
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column_name"), F.col(c).alias("present")) for kind, c in found]
    return counts.select(F.inline(F.array(*rows)))
