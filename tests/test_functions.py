import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymart.functions import (
    band_lookup,
    band_thresholds,
    clean_name,
    columns_matching,
    likely_fields,
    missing_text,
    parse_month,
    row_sum,
    safe_ratio,
    strip_prefix,
    unique_clean_names,
)
from tallymart.plans import contracts as C
from published import AE_HEADERS, waiting_header


def test_clean_name_on_published_headers():
    assert clean_name("Gt 00 To 01 Weeks SUM 1") == "gt_00_to_01_weeks_sum_1"
    for cleaned, header in AE_HEADERS.items():
        assert clean_name(header) == cleaned
    for cleaned in C.WAITING_TEXT + C.WAITING_COUNTS:
        assert clean_name(waiting_header(cleaned)) == cleaned


@pytest.mark.parametrize(
    "raw, clean",
    [("OrgCode", "org_code"), ("RTTPart", "rtt_part"), ("% seen", "percent_seen"), ("#", "number"), ("2nd", "x2nd"),
     ("", "x"), ("Café", "cafe"), ("O'Neil", "o_neil"), ("It's", "its"), ("a--b", "a_b")],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_repeated_names_are_numbered():
    assert unique_clean_names(["Total", "total", "TOTAL.", "total 2"]) == ["total", "total_2", "total_3", "total_2_2"]


def test_column_search():
    names = ["Period", "provider_org_code", "gt_00_to_01_weeks_sum_1"]
    assert columns_matching(names, "period|month") == ["Period"]
    assert columns_matching(names, "period", ignore_case=False) == []


def test_likely_fields():
    patterns = {"when": "^period|date$", "who": "^provider", "what": "function_", "band": "^gt_"}
    found = likely_fields(C.WAITING_TEXT + C.WAITING_COUNTS, patterns)
    assert found["when"] == ["period", "patients_with_unknown_clock_start_date"]
    assert found["who"][:2] == ["provider_parent_org_code", "provider_parent_name"]
    assert found["what"] == ["treatment_function_code", "treatment_function_name"]
    assert len(found["band"]) == 105


def test_band_lookup_finds_all_105_bands():
    bands = band_lookup(C.WAITING_TEXT + C.WAITING_COUNTS, C.BAND_PATTERN)
    assert list(bands.values()) == list(range(105))


def test_parse_month(spark):
    texts = ["RTT-AUGUST-2026", "RTT-August-2026", "Aug-2026", "rtt-August-2026", "RTT-zz", None, "TOTAL", "RTT-May 2026", "08/2026", "RTT-", "", "13 2026", "aug_2026", "Aug-26", "AUG2026", "8/26", "May-69", "June-68", "May-1969"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(parse_month("t", "RTT-")).collect()]
    august = datetime.date(2026, 8, 1)
    assert got == [august, august, august, None, None, None, None, datetime.date(2026, 5, 1), august, None, None, None, august, august, august, august, datetime.date(1969, 5, 1), datetime.date(2068, 6, 1), datetime.date(1969, 5, 1)]


def test_missing_text_and_prefix(spark):
    rows = spark.createDataFrame([("",), ("NA",), ("  ",), (" x ",), (None,), ("na",)], "t string")
    assert [r[0] for r in rows.select(missing_text("t")).collect()] == [None, None, None, "x", None, "na"]
    rows = spark.createDataFrame([("a.b-1",), ("axb-1",)], "t string")
    assert [r[0] for r in rows.select(strip_prefix("t", "a.b-")).collect()] == ["1", "axb-1"]


def test_safe_ratio(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2), (-1, 2), (3, -1)], "n long, d long")
    assert [r[0] for r in rows.select(safe_ratio("n", "d")).collect()] == [0.5, None, None, None, -0.5, None]


def test_row_sums(spark):
    rows = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, None)], "a int, b int, c int")
    cols = ["a", "b", "c"]
    assert [r[0] for r in rows.select(row_sum(cols)).collect()] == [6, 4, 0]
    assert [r[0] for r in rows.select(row_sum(cols, nulls="propagate")).collect()] == [6, None, None]
    assert rows.select(row_sum([])).first()[0] == 0
    with pytest.raises(ValueError):
        row_sum(cols, nulls="maybe")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=12, max_size=12), min_size=1, max_size=6),
    st.lists(st.integers(1, 11), min_size=1, max_size=4, unique=True),
)
def test_band_thresholds_against_plain_sums(spark, data, cuts):
    names = [f"b{i}" for i in range(12)]
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)], "i int, " + ", ".join(f"{n} int" for n in names)
    )
    got = band_thresholds(df, {n: i for i, n in enumerate(names)}, cuts).orderBy("i").collect()
    for row, values in zip(got, data):
        low = min(cuts)
        assert row[f"within_{low}_weeks"] == sum(v or 0 for v in values[:low])
        for cut in cuts:
            assert row[f"over_{cut}_weeks"] == sum(v or 0 for v in values[cut:])


def test_thresholds_of_missing_bands_are_zero(spark):
    df = spark.createDataFrame([(None, None)], "gt_00_to_01_weeks_sum_1 int, gt_104_weeks_sum_1 int")
    row = band_thresholds(df, band_lookup(df, C.BAND_PATTERN), C.CUTS).first()
    assert [row[c] for c in C.BACKLOG] == [0] * 6
