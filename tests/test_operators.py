"""Hand-computed cases, most with a planted defect that a check has to find."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallymart.operators import (
    any_text_equals,
    attribute_dim,
    band_reconciliation,
    character_profile,
    conflicting_attributes,
    count_by,
    dataset_overview,
    date_dim,
    drilldown,
    drop_totals,
    duplicate_keys,
    entity_dim,
    exact_duplicates,
    first_n,
    foreign_key_check,
    grain_reconciliation,
    guess_schema,
    guess_types,
    latest_period,
    match_tally,
    missing_keys,
    missing_profile,
    month_on_month,
    numeric_profile,
    order,
    published_total_check,
    qa_summary,
    range_check,
    rank_within,
    reconciliation_summary,
    rows_and_distinct,
    share_of_total,
    stats_to_long,
    status_tally,
    sum_all_numeric,
    type_profile,
    unique_key_check,
    valid_key,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def month(m, year=2026):
    return dt.date(year, m, 1)


def test_totals_are_dropped_in_any_case_and_missing_goes_too(spark):
    df = spark.createDataFrame([("total",), ("Total",), ("TOTAL",), (None,), ("x",)], "period string")
    assert rows(drop_totals(df, "period")) == [("x",)]
    assert drop_totals(df, "period", keep=True).count() == 3


def test_any_text_column_may_hold_the_label(spark):
    df = spark.createDataFrame([("a", "Total", 1), (None, "TOTAL", 2), ("x", None, 3)], "`a b` string, c string, n int")
    assert [r[2] for r in rows(any_text_equals(df))] == [1, 2]
    assert any_text_equals(df.select("n")).count() == 0


def test_valid_key(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "k string")
    assert rows(valid_key(df, "k")) == [("x",)]


def test_order_puts_missing_last_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r[0] for r in rows(order(df, "a"))] == [1, 2, None]
    assert [r[0] for r in rows(order(df, "-a"))] == [2, 1, None]
    assert [r[0] for r in rows(first_n(df, 2, "-a"))] == [2, 1]


def test_repeated_month_and_provider(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "A"), (1, None), (1, None)], "m int, p string")
    assert sorted(rows(duplicate_keys(df, ["m", "p"])), key=str) == [(1, "A", 2), (1, None, 2)]
    assert unique_key_check("dup", df, ["m", "p"]).first() == ("dup", 2)


def test_renamed_provider(spark):
    df = spark.createDataFrame([(1, "A", "old"), (2, "A", "new"), (1, "B", None), (2, "B", "b"), (1, "C", "c")], "m int, p string, n string")
    assert sorted(rows(conflicting_attributes(df, "p", "n"))) == [("A", 2), ("B", 2)]
    assert unique_key_check("dup", df, ["m", "p"]).first()[1] == 0


def test_foreign_keys(spark):
    fact = spark.createDataFrame([("A",), ("A",), ("Z",), (None,)], "code string")
    dim = spark.createDataFrame([("A",), (None,)], "k string")
    assert rows(missing_keys(fact, dim, "code", "k")) == [("Z",)]
    assert foreign_key_check("fk", fact, dim, "code", "k").first() == ("fk", 1)
    assert foreign_key_check("fk", fact, dim, "code", "k", null_safe=False).first() == ("fk", 2)
    assert foreign_key_check("fk", fact, dim.filter("k = 'A'"), "code", "k").first() == ("fk", 2)
    assert foreign_key_check("fk", fact.filter("code = 'A'"), dim, "code", "k").first() == ("fk", 0)
    twice = dim.union(dim)
    assert rows(missing_keys(fact, twice, "code", "k", unique=False)) == [("Z",)]
    assert rows(missing_keys(fact, twice, "code", "k")) == [("Z",)]
    same = dim.withColumnRenamed("k", "code")
    assert rows(missing_keys(fact, same, "code")) == [("Z",)]


def test_total_row_one_off_and_one_metric_missing(spark):
    df = spark.createDataFrame(
        [("f", "x", 1, 1, 1), ("f", "y", 2, 2, None), ("f", "TOTAL", 3, 4, None), ("g", "x", 5, 5, 5)],
        "source_file string, period string, a int, b int, c int",
    )
    checked = published_total_check(drop_totals(df, "period"), drop_totals(df, "period", keep=True), "source_file")
    got = {(r.source_file, r.metric): r for r in checked.collect()}
    assert (got["f", "a"].matches, got["f", "b"].matches, got["f", "b"].difference) == (True, False, -1)
    assert got["f", "c"].calculated_total == 1 and got["f", "c"].matches is None
    assert got["g", "a"].published_total is None
    assert {r.matches: r.n for r in match_tally(checked).collect()} == {True: 1, False: 1, None: 4}


def test_band_mismatch(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 1, 3), (0, 0, 1), (0, 0, None)], "w long, o long, total long")
    got = band_reconciliation(df, ["w", "o"], "total").first()
    assert (got["rows"], got.total_matches, got.total_mismatches) == (4, 1, 2)


def test_grain_reconciliation_and_what_it_cannot_match(spark):
    coarse = spark.createDataFrame([(1, "A", 10), (1, "B", 5), (1, None, 2)], "m int, p string, t long")
    fine = spark.createDataFrame([(1, "A", 4), (1, "A", 5), (1, None, 2), (2, "A", 9)], "m int, p string, t long")
    diffs = grain_reconciliation(coarse, fine, ["m", "p"], ["t"])
    assert {r.p: (r.t, r.fine_t, r.t_difference) for r in diffs.collect()} == {
        "A": (10, 9, 1),
        "B": (5, None, None),
        None: (2, 2, 0),
    }
    assert rows(reconciliation_summary(diffs, "t_difference", unmatched="unmatched")) == [(3, 1, 1, 1, 1)]
    assert rows(missing_keys(fine.select("m", "p").distinct(), coarse, ["m", "p"])) == [(2, "A")]


def test_largest_difference_of_nothing_is_missing(spark):
    empty = spark.createDataFrame([], "d long")
    assert rows(reconciliation_summary(empty, "d")) == [(0, 0, 0, None)]


def test_qa_summary(spark):
    df = spark.createDataFrame([(1.5,), (-0.1,), (None,)], "p double")
    checks = [
        unique_key_check("unique", df, "p"),
        range_check(df, {"above 1": F.col("p") > 1, "below -5": F.col("p") < -5}),
    ]
    qa = qa_summary(checks, ["below -5", "unique", "above 1"])
    assert rows(qa) == [("below -5", 0, "PASS"), ("unique", 0, "PASS"), ("above 1", 1, "REVIEW")]
    assert rows(status_tally(qa)) == [(3, 2, 1, False)]


def test_missing_profile_rounds_like_the_published_one(spark):
    # Published missing counts and percentages of 723,735 rows.
    published = [(589820, 81.5), (522421, 72.18), (234701, 32.43), (234687, 32.43)]
    counts = spark.createDataFrame([(c, p) for c, p in published], "n long, pct double")
    got = counts.select(F.bround(F.col("n") / F.lit(723735) * 100, 2), "pct").collect()
    assert all(a == b for a, b in got)


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5, None), ("a", -2, None, None), (None, 0, None, None)], "`s.x` string, n int, d double, e string"
    )
    assert rows(missing_profile(df)) == [("e", 3, 100.0), ("d", 2, 66.67), ("s.x", 1, 33.33), ("n", 0, 0.0)]
    assert {r[0]: tuple(r)[1:] for r in numeric_profile(df).collect()} == {
        "n": (-2.0, 1.0, 1, 1),
        "d": (0.5, 0.5, 0, 0),
    }
    assert rows(character_profile(df)) == [("s.x", 2), ("e", 1)]
    assert rows(type_profile(df))[:2] == [("s.x", "character"), ("n", "numeric")]
    assert rows(type_profile(df, spark_names=True))[2] == ("d", "double")
    whole = stats_to_long(df, ["n"], {"low": F.min, "high": F.max})
    assert rows(whole) == [("n", -2, 1)]


@pytest.mark.parametrize("per_scan", [1, 7, 16, 100])
def test_wide_profiles_are_the_same_in_one_or_many_scans(spark, per_scan):
    names = [f"c{i}" for i in range(40)]
    data = [tuple(None if (i + j) % 5 == 0 else i - j for i in range(40)) for j in range(30)]
    df = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names))
    got = {r.metric: (r.min, r.max, r.zero_count, r.negative_count) for r in numeric_profile(df, per_scan=per_scan).collect()}
    missing = {r.column_name: r.missing_count for r in missing_profile(df, per_scan).collect()}
    for i, n in enumerate(names):
        known = [row[i] for row in data if row[i] is not None]
        assert got[n] == (min(known), max(known), known.count(0), sum(v < 0 for v in known))
        assert missing[n] == len(data) - len(known)
    empty = df.filter("false")
    assert numeric_profile(empty, per_scan=per_scan).filter("min IS NULL AND zero_count = 0").count() == 40


def test_profiles_of_an_empty_table_keep_their_columns(spark):
    df = spark.createDataFrame([], "s string, n int")
    assert rows(missing_profile(df)) == [("s", 0, None), ("n", 0, None)]
    assert rows(numeric_profile(df)) == [("n", None, None, 0, 0)]
    assert rows(character_profile(df)) == [("s", 0)]
    assert exact_duplicates(df).first()[0] == 0
    assert rows(numeric_profile(df.select("s"))) == [] and rows(character_profile(df.select("n"))) == []
    assert rows(dataset_overview(df, "s")) == [(0, 2, 0)]


def test_types_are_guessed_from_all_values(spark):
    df = spark.createDataFrame(
        [
            ("1", "T", "2026-04-01", "x", None, "1", "TRUE", "007", "2026-04-01"),
            ("-2.5e3", "false", "2026-02-30", "1", None, None, "1", "1", "2024-02-29"),
        ],
        "n string, b string, d string, s string, e string, m string, mixed string, code string, day string",
    )
    got = {r.column_name: r.data_type for r in guess_types(df).collect()}
    assert got == {
        "n": "numeric", "b": "logical", "d": "character", "s": "character", "e": "logical", "m": "numeric",
        "mixed": "character", "code": "character", "day": "Date",
    }
    schema = guess_schema(df)
    assert schema.names == df.columns and schema["n"].dataType.simpleString() == "double"


def test_long_texts_are_told_apart(spark):
    base = "x" * 70
    texts = [base, base, base + "y", "#" + "a" * 64, None, "", "x" * 64]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows(character_profile(df)) == [("t", 6)]


@pytest.mark.parametrize("digest", [False, True])
def test_exact_duplicates(spark, digest):
    when = dt.datetime(2026, 1, 1, 0, 0, 0, 1)
    data = [(None, "x", 0.0, when)] * 3 + [("x", None, 0.0, when), ("", None, -0.0, when), ("", None, 0.0, when)]
    data += [("", None, 0.0, when.replace(microsecond=2)), ('"', "a,b", float("nan"), when), ('"', "a,b", float("nan"), when)]
    df = spark.createDataFrame(data, "a string, b string, c double, t timestamp_ntz")
    assert exact_duplicates(df, digest=digest).first()[0] == 2 + 1 + 1


def test_grouped_counts_see_missing_as_a_value(spark):
    df = spark.createDataFrame([("g", "a"), ("g", None), ("g", None), (None, "a")], "g string, c string")
    assert sorted(rows(rows_and_distinct(df, "g", "c")), key=str) == [("g", 3, 2), (None, 1, 1)]
    assert rows(count_by(df, "c", sort=True)) == [("a", 2), (None, 2)]


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None, 1.5), ("a", None, None)], "k string, n int, d double")
    assert rows(sum_all_numeric(df, "k")) == [("a", 0, 1.5)]


def test_date_dim_matches_published_rows(spark):
    # The published date dimension.
    published = """2026-04-01,2026,4,April,Apr,2026-04,Apr 2026,Q2,2026 Q2
2026-05-01,2026,5,May,May,2026-05,May 2026,Q2,2026 Q2
2026-06-01,2026,6,June,Jun,2026-06,Jun 2026,Q2,2026 Q2
2026-07-01,2026,7,July,Jul,2026-07,Jul 2026,Q3,2026 Q3
2026-08-01,2026,8,August,Aug,2026-08,Aug 2026,Q3,2026 Q3"""
    first = spark.createDataFrame([(month(8),), (None,), (month(5),)], "report_month date")
    second = spark.createDataFrame([(month(4),)], "report_month date")
    got = rows(order(date_dim([first, second]), "report_month"))
    assert "\n".join(",".join(map(str, r)) for r in got) == published
    assert date_dim([first.filter("false")]).count() == 0


def test_attribute_dim_sorts_by_name(spark):
    df = spark.createDataFrame(
        [("C_320", "Cardiology Service"), ("X02", "Other - Medical Services"), ("C_320", "Cardiology Service"),
         ("", "blank"), (None, "none"), ("C_101", "Urology Service"), ("C_140", "Oral Surgery Service")],
        "code string, name string",
    )
    assert [r[0] for r in rows(attribute_dim(df, "code", "name"))] == ["C_320", "C_140", "X02", "C_101"]


HISTORY = "code string, name string, pc string, pn string, m date, src int"


def provider_rows(spark, data):
    dim = entity_dim(
        spark.createDataFrame(data, HISTORY),
        "code",
        source="src",
        period="m",
        last=["name", "pn"],
        first=["pc"],
        tie_break=["pc", "pn"],
        flags={"in_1": F.col("src") == 1, "in_2": F.col("src") == 2},
    )
    return {r.code: (r.name, r.pc, r.pn, r.in_1, r.in_2) for r in dim.collect()}


def test_second_source_wins_over_newer_first_source(spark):
    got = provider_rows(
        spark,
        [
            ("A", "newest in first", None, "region", month(8), 1),
            ("A", "second old", "P1", "parent old", month(4), 2),
            ("A", "second new", "P2", "parent new", month(5), 2),
            ("A", None, "P3", None, month(6), 2),
            ("B", "only first", None, None, month(4), 1),
            ("", "blank", None, None, month(4), 1),
            (None, "none", None, None, month(4), 1),
        ],
    )
    assert got == {
        "A": ("second new", "P1", "parent new", True, True),
        "B": ("only first", None, None, True, False),
    }


def test_entity_dim_against_sorting_every_row(spark):
    rnd = random.Random(5)
    pick = lambda *xs: rnd.choice(xs)
    data = [
        (pick("A", "B", "C"), pick(None, "n1", "n2", "n3"), pick(None, "p1", "p2"), pick(None, "q1", "q2"),
         pick(None, month(1), month(2), month(3)), pick(1, 2))
        for _ in range(150)
    ]
    place = lambda v: (v is None, v if v is not None else "")
    key = lambda r: (r[5], r[4] is None, r[4] or month(1), place(r[2]), place(r[3]), place(r[1]))
    want = {}
    for code in "ABC":
        mine = sorted((r for r in data if r[0] == code), key=key)
        known = lambda i: [r[i] for r in mine if r[i] is not None]  # noqa: B023, E731
        want[code] = (known(1)[-1], known(2)[0], known(3)[-1], any(r[5] == 1 for r in mine), any(r[5] == 2 for r in mine))
    assert provider_rows(spark, data) == want


def test_rank_against_counting(spark):
    rnd = random.Random(3)
    values = [None, 0.0, -2.5, 1e-9, 0.91, 0.91, 0.910001, 7.0, 7.0, 1e12, -1e-12]
    data = [(i, rnd.choice("ab") if i % 9 else None, rnd.choice(values)) for i in range(200)]
    data += [(1000 + i, "a", 7.0) for i in range(100)]  # one value holds a third of the rows
    df = spark.createDataFrame(data, "i int, g string, v double")
    for descending in (True, False):
        got = {r.i: (r["rank"], r.percent_rank) for r in rank_within(df, "g", "v", descending=descending).collect()}
        assert len(got) == len(data)
        for i, g, v in data:
            peers = [x for _, h, x in data if h == g and x is not None]
            if v is None:
                assert got[i] == (None, None)
                continue
            rank = 1 + sum((x > v) if descending else (x < v) for x in peers)
            assert got[i][0] == rank
            assert got[i][1] == pytest.approx((rank - 1) / (len(peers) - 1))


def test_reports(spark):
    df = spark.createDataFrame(
        [(month(1), "A", 10), (month(2), "A", 4), (month(3), "A", 4), (month(3), "B", 0)], "report_month date, p string, v long"
    )
    trend = {(r.p, r.report_month.month): r.trend for r in month_on_month(df, "p", "v").collect()}
    assert trend == {("A", 1): None, ("A", 2): "improving", ("A", 3): "stable", ("B", 3): None}
    assert latest_period(df).count() == 2
    shares = {(r.report_month.month, r.p): r.share for r in share_of_total(df, "report_month", "p", "v").collect()}
    assert shares == {(1, "A"): 1.0, (2, "A"): 1.0, (3, "A"): 1.0, (3, "B"): 0.0}
    assert drilldown(df, {"p": ["A"], "report_month": (month(2), month(3))}).count() == 2
