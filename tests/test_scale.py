"""Shape of the plans, and results when one key holds a third of all rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from sfqueries import REGISTRY
from sfqueries.facts import bands_to_columns, provider_fact, published_rows, wide_bands
from tallymart.operators import (
    build_fact,
    character_profile,
    conflicting_attributes,
    entity_dim,
    exact_duplicates,
    foreign_key_check,
    join_on,
    missing_keys,
    rank_within,
    rows_and_distinct,
)
from tallymart.plans.contracts import band_columns
from tallymart.sources import save_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not n.startswith("model_")))
def test_no_query_pairs_every_row_with_every_row(no_broadcast, name):
    text = plan(REGISTRY[name].run(no_broadcast, TESTDATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_fact_reads_only_what_it_needs(spark):
    text = plan(provider_fact(spark, TESTDATA))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    columns = {c.split("#")[0] for scan in scans for c in scan.split(",")}
    assert columns == {
        "l_orderkey", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate", "o_orderkey", "o_orderdate", "o_orderpriority"
    }
    assert "EqualTo(l_returnflag,N)" in text


def test_row_counts_read_no_column(spark):
    text = plan(REGISTRY["table_counts"].run(spark, TESTDATA))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)) == {"struct<>"}


def test_sums_are_combined_before_they_are_shuffled(spark):
    text = plan(provider_fact(spark, TESTDATA))
    below = text[text.index("Exchange hashpartitioning(report_month") :]
    assert "partial_sum(total_waiting" in below


@pytest.mark.parametrize("rows", [published_rows, wide_bands])
def test_no_task_holds_all_cells_of_its_keys(spark, rows):
    assert "pivotfirst" not in plan(rows(spark, TESTDATA))


def test_bands_to_columns(spark):
    cells = [(1, 0, 5), (1, 0, 2), (1, 104, None), (1, 104, 3), (1, 7, None), (None, 3, 4), (None, 3, 4), (2, None, 9), (2, None, 9)]
    out = bands_to_columns(spark.createDataFrame(cells, "k int, band int, pathways bigint"), ["k"])
    assert out.columns == ["k", *band_columns()]
    found = {r[0]: {w: n for w, n in enumerate(r[1:]) if n is not None} for r in out.collect()}
    assert found == {1: {0: 7, 104: 3}, None: {3: 8}, 2: {}} and out.count() == 3


def test_key_check_shuffles_keys_not_rows(no_broadcast):
    fact = no_broadcast.range(1000).select((F.col("id") * 0).alias("k"), F.lit("payload").alias("x"))
    dim = no_broadcast.range(5).withColumnRenamed("id", "k")
    check = foreign_key_check("fk", fact, dim, "k")
    text = plan(check)
    assert text.index("LeftAnti") < text.index("partial_count(1)", text.index("LeftAnti"))
    assert check.first()[1] == 0


def test_saved_month_with_most_rows_is_split(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        month = F.when(F.col("id") % 3 == 0, F.lit("2026-04-01")).otherwise(
            F.concat(F.lit("2026-0"), (F.col("id") % 4 + 5).cast("string"), F.lit("-01"))
        )
        df = spark.range(0, 300_000, 1, 16).select("id", month.cast("date").alias("report_month"))
        back = save_table(df, str(tmp_path / "t"), ["report_month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "t").glob("report_month=*")}
    assert files["report_month=2026-04-01"] > 1
    assert back.agg(F.sum("id"), F.count("id")).first() == (300_000 * 299_999 // 2, 300_000)


@pytest.fixture
def small_partitions(no_broadcast):
    """Adaptive execution as for large data, at the size of a test."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for name, value in limits.items():
        no_broadcast.conf.set(name, value)
    yield no_broadcast
    for name in limits:
        no_broadcast.conf.unset(name)


@pytest.mark.parametrize("join", ["left", "anti"])
def test_rows_of_a_hot_join_key_are_split_over_tasks(small_partitions, join):
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    fact = small_partitions.range(0, 60_000, 1, 8).select("id", hot.alias("k"))
    dim = small_partitions.range(0, 60_000, 1, 8).select((F.col("id") * 2).alias("k"), F.lit("x").alias("name"))
    if join == "left":
        out = join_on(fact, dim, "k")
        want = 60_000
    else:
        out = missing_keys(fact, dim, "k")
        want = 20_000 + sum(1 for i in range(60_000) if i % 3 and i % 2)
    out.write.format("noop").mode("overwrite").save()
    assert len(out.collect()) == want
    assert "SortMergeJoin(skew=true)" in plan(out)


# One key holds a third of the rows.

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return (
        spark.range(0, N, 1, 8)
        .select(
            i,
            F.when(hot, "HOT").otherwise(F.concat(F.lit("K"), (i % 997).cast("string"))).alias("code"),
            F.when(hot, F.concat(F.lit("name "), (i % 11).cast("string"))).otherwise("same").alias("name"),
            F.when(hot, F.lit(1.0)).otherwise((i % 500) / 500.0).alias("share"),
            F.lit(1).alias("source"),
            F.date_add(F.lit(dt.date(2026, 1, 1)), (i % 300).cast("int")).alias("day"),
            F.lit(2).cast("bigint").alias("n"),
        )
        .cache()
    )


def test_skewed_sums_and_counts(skewed):
    fact = {r.code: r.n for r in build_fact(skewed, "code", ["n"]).collect()}
    assert fact["HOT"] == 2 * N // 3 and sum(fact.values()) == 2 * N
    counts = {r.code: (r["rows"], r.distinct_name) for r in rows_and_distinct(skewed, "code", "name").collect()}
    assert counts["HOT"] == (N // 3, 11)
    assert [tuple(r) for r in conflicting_attributes(skewed, "code", "name").collect()] == [("HOT", 11)]
    assert exact_duplicates(skewed, ["code", "name"]).first()[0] == N - 11 - 997
    assert {r[0]: r[1] for r in character_profile(skewed).collect()} == {"code": 998, "name": 12}


def test_skewed_key_checks(spark, skewed):
    dim = spark.createDataFrame([("HOT",)], "code string")
    assert foreign_key_check("fk", skewed, dim, "code").first()[1] == N - N // 3
    assert foreign_key_check("fk", skewed, skewed.filter("code <> 'HOT'").select("code").distinct(), "code").first()[1] == N // 3


def test_skewed_history(skewed):
    dim = entity_dim(skewed, "code", source="source", period="day", last=["name"], flags={"any": F.col("id") == 0})
    rows = {r.code: (r.name, r.any) for r in dim.collect()}
    # The last day of the year's 300 comes up for ids 299, 599, ...; every third of them is hot.
    last = max((i % 300, f"name {i % 11}") for i in range(0, N, 3))
    assert rows["HOT"] == (last[1], True) and len(rows) == 998


def test_skewed_rank(skewed):
    ranked = rank_within(skewed.withColumn("g", F.lit("all")), "g", "share")
    assert ranked.count() == N
    top = ranked.filter("share = 1.0").agg(F.min("rank"), F.max("rank"), F.count("id")).first()
    assert tuple(top) == (1, 1, N // 3)
    bottom = ranked.filter("share = 0.0").select("rank").distinct().collect()
    assert [r[0] for r in bottom] == [1 + sum(1 for i in range(N) if i % 3 == 0 or i % 500 > 0)]
