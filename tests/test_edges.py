"""Cases the tables do not hold: fractions, NaN, clock changes, padded text, many layouts, awkward names."""

import datetime
import os
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import row_sum
from tallymart.operators import band_reconciliation, exact_duplicates, published_total_check, rank_within
from tallymart.sources import _tasks, export_check, file_manifest, files_with_breaks, read_csv, read_headers, read_zip_csv, write_csv


def test_fractions_are_not_cut(spark):
    rows = spark.createDataFrame([(0.5, 0.6, None)], "a double, b double, c double")
    assert rows.select(row_sum(["a", "b", "c"])).first()[0] == 1.1
    parts = spark.createDataFrame([(0.9, 0.9, 0)], "a double, b double, total bigint")
    found = band_reconciliation(parts, ["a", "b"], "total").first()
    assert (found.total_matches, found.total_mismatches) == (0, 1)
    file = spark.createDataFrame([("f", 10.4), ("f", 0.5)], "file string, n double")
    totals = spark.createDataFrame([("f", 10.1)], "file string, n double")
    checked = published_total_check(file, totals, "file").first()
    assert not checked.matches and abs(checked.difference - 0.8) < 1e-9
    decimals = "file string, n decimal(12,2)"
    same = published_total_check(
        file.selectExpr("file", "cast(n as decimal(12,2)) n"), spark.createDataFrame([], decimals).union(totals.selectExpr("file", "cast(10.90 as decimal(12,2))")), "file"
    ).first()
    assert same.matches


def test_instants_across_a_clock_change_differ(spark):
    base = datetime.datetime(2026, 11, 1, 5, 30, tzinfo=datetime.timezone.utc)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([(base,), (base + datetime.timedelta(hours=1),)], "t timestamp")
        rows = rows.select("t", *[F.lit(1).alias(f"c{i}") for i in range(17)])
        assert exact_duplicates(rows).first()[0] == exact_duplicates(rows, digest=True).first()[0] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_digests_keep_bytes_apart_and_zeros_together(spark):
    odd = spark.sql("SELECT X'FF' AS b UNION ALL SELECT X'FE'")
    assert exact_duplicates(odd, digest=True).first()[0] == 0
    zeros = spark.sql("SELECT array(0.0D) AS z UNION ALL SELECT array(-0.0D)")
    assert exact_duplicates(zeros).first()[0] == exact_duplicates(zeros, digest=True).first()[0] == 1


def test_nan_ranks_above_numbers(spark):
    rows = spark.createDataFrame([("g", float("nan")), ("g", 1.0), ("g", float("inf")), ("g", -2.0)], "k string, v double")
    found = {str(r.v): r["rank"] for r in rank_within(rows, "k", "v").collect()}
    assert found == {"nan": 1, "inf": 2, "1.0": 3, "-2.0": 4}


def test_padded_text_and_folder_names(spark, tmp_path):
    folder = str(tmp_path / "out")
    write_csv(spark.createDataFrame([("  padded ",)], "x string").coalesce(1), f"{folder}/readout")
    text = "".join(open(f"{folder}/readout/{n}").read() for n in os.listdir(f"{folder}/readout") if n.endswith(".csv"))
    assert "  padded " in text
    found = {r.file_name: r.exists for r in export_check(spark, ["readout", "lost"], folder).collect()}
    assert found == {"readout": True, "lost": False}


def test_doubles_add_up_as_written(spark):
    """0.1 + 0.2 is 0.3, in any order; what is no number stops the check."""
    rows = spark.createDataFrame([("f", 0.1, 1), ("f", 0.2, 2), ("g", 1e-9, 3)], "file string, x double, n int")
    totals = spark.createDataFrame([("f", 0.3, 3), ("g", 0.0, 3)], "file string, x double, n int")
    found = {(r.file, r.metric): (r.matches, r.difference) for r in published_total_check(rows, totals, "file").collect()}
    assert found == {("f", "x"): (True, 0.0), ("f", "n"): (True, 0.0), ("g", "x"): (False, 1e-9), ("g", "n"): (True, 0.0)}
    bands = spark.createDataFrame([(0.1, 0.2, 0.3), (0.1, 0.2, 0.4)], "a double, b double, t double")
    one = band_reconciliation(bands, ["a", "b"], "t").first()
    assert (one.total_matches, one.total_mismatches) == (1, 1)
    odd = spark.createDataFrame([("f", float("nan"))], "file string, x double")
    with pytest.raises(Exception, match="no exact sum"):
        published_total_check(odd, totals.drop("n"), "file").collect()


def test_more_than_500_layouts(spark, tmp_path):
    for i in range(505):
        (tmp_path / f"f{i}.csv").write_text(f"k,extra_{i}\n{i},x\n")
    rows = read_csv(spark, str(tmp_path), T.StructType().add("k", "integer"), lineage=None)
    assert sorted(r.k for r in rows.collect()) == list(range(505)) and rows.columns == ["k"]


def test_one_scan_for_many_layouts(spark, tmp_path):
    """Each file orders its columns in its own way; the plan has one scan and all cells are found."""
    import itertools

    for i, order in enumerate(itertools.permutations("abcde")):
        (tmp_path / f"f {i}.csv").write_text(",".join(order) + "\n" + ",".join(f"{c}{i}" for c in order) + "\n")
    rows = read_csv(spark, str(tmp_path))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2
    found = {tuple(r[c] for c in "abcde") + (r.source_file,) for r in rows.collect()}
    assert found == {tuple(f"{c}{i}" for c in "abcde") + (f"f {i}.csv",) for i in range(120)}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('k,t\n1,"a ""b"" c"\n2,d\n')
    (tmp_path / "breaks.csv").write_text('k,t\n3,"x\ny"\n4,"\n""z"",\n"\n5,e\n')
    (tmp_path / "other.csv").write_text('t,k\n"u\n\nv",6\n')
    rows = {(r.k, r.t, r.source_file) for r in read_csv(spark, str(tmp_path)).collect()}
    assert rows == {
        ("1", 'a "b" c', "plain.csv"), ("2", "d", "plain.csv"), ("3", "x\ny", "breaks.csv"), ("4", '\n"z",\n', "breaks.csv"),
        ("5", "e", "breaks.csv"), ("6", "u\n\nv", "other.csv"),
    }
    found = files_with_breaks(spark, str(tmp_path)).collect()
    assert sorted(os.path.basename(r.path) for r in found) == ["breaks.csv", "other.csv"]


def test_counts_written_as_doubles(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n12.0\n1e3\n7\n-0.0\nNA\n 5 \n")
    schema = T.StructType().add("k", "long")
    assert [r.k for r in read_csv(spark, str(tmp_path), schema, lineage=None).collect()] == [12, 1000, 7, 0, None, 5]


def test_a_header_is_read_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    (tmp_path / "b.csv").write_text("k,l\n2,3\n")
    manifest = file_manifest(spark, str(tmp_path))
    headers = read_headers(spark, str(tmp_path), manifest=manifest)
    (tmp_path / "a.csv").rename(tmp_path / "a.moved")
    assert sorted((r.file, r.column_name) for r in headers.collect()) == [("a.csv", "k"), ("b.csv", "k"), ("b.csv", "l")]


def test_archives_and_members_of_one_name(spark, tmp_path):
    for year in ("2025", "2026"):
        (tmp_path / year).mkdir()
        with zipfile.ZipFile(tmp_path / year / "data.zip", "w") as archive:
            archive.writestr("a.csv", f"code,n\n{year},1\n")
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                archive.writestr("a.csv", f"code,n\n{year},2\n")
    folders = [str(tmp_path / "2025"), str(tmp_path / "2026")]
    got = read_zip_csv(spark, folders, stage=f"{tmp_path}/stage").collect()
    assert sorted((r.code, r.n) for r in got) == [("2025", "1"), ("2025", "2"), ("2026", "1"), ("2026", "2")]
    assert {r.source_file for r in got} == {"a.csv"}


def test_short_manifest_stops(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "data.zip", "w") as archive:
        archive.writestr("a.csv", "code,n\nA,1\n")
        archive.writestr("b.csv", "code,n\nB,1\n")
    monkeypatch.setattr(_tasks, "unpack_rows", lambda target: lambda batches: (b.iloc[:0] for b in batches))
    with pytest.raises(ValueError, match="unpacked"):
        read_zip_csv(spark, str(tmp_path), stage=f"{tmp_path}/stage")
