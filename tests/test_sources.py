"""Files with drifting layouts, awkward cells and archives of several members."""

import datetime as dt
import io
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from tallymart.operators import schema_presence
from tallymart.sources import (
    column_counts,
    export_check,
    list_sources,
    load_table,
    new_stage,
    read_csv,
    read_headers,
    read_zip_csv,
    save_table,
    stack_files,
    with_lineage,
    write_csv,
    zip_catalogue,
)
from tallymart.sources import _tasks
from tallymart.sources.staging import shared_root
from published import write_zip

SCHEMA = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())]
)


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_columns_bind_by_name_in_every_layout(spark, tmp_path):
    write(tmp_path / "a.csv", "code,name,n\nA,one,1\n")
    write(tmp_path / "sub" / "b b.csv", "n,code,name\n2,B,two\n", "utf-8-sig")
    write(tmp_path / "sub" / "c.csv", "name,extra,code\nthree,x,C\n")
    write(tmp_path / "d.txt", "not,a,csv\n")
    got = read_csv(spark, str(tmp_path), SCHEMA)
    assert as_set(got) == {
        ("A", "one", 1, "a.csv"),
        ("B", "two", 2, "b b.csv"),
        ("C", "three", None, "c.csv"),
    }
    wide = read_csv(spark, str(tmp_path), SCHEMA, keep_extra=True, lineage=None)
    assert {(r.code, r.extra) for r in wide.collect()} == {("A", None), ("B", None), ("C", "x")}
    assert read_csv(spark, str(tmp_path), SCHEMA, recursive=False).count() == 1


def test_awkward_file_names(spark, tmp_path):
    names = ["a [1].csv", "b{x,y}.csv", "c%20d.csv", "e*f+g.csv"]
    for i, name in enumerate(names):
        order = "code,n" if i % 2 else "n,code"
        write(tmp_path / "x y" / name, f"{order}\n{i},{i}\n")
    got = read_csv(spark, str(tmp_path / "x y"), SCHEMA)
    assert as_set(got.select("code", "n")) == {(str(i), i) for i in range(4)}
    assert got.select("source_file").distinct().count() == 4


def test_missing_cells(spark, tmp_path):
    write(tmp_path / "a.csv", 'code,name,n\n,NA,NA\n"","  ",""\n x ," y y ", 7 \n"NA","a,""b""",3\n')
    got = read_csv(spark, str(tmp_path), SCHEMA, lineage=None)
    assert as_set(got) == {(None, None, None), ("x", "y y", 7), (None, 'a,"b"', 3)}
    assert got.count() == 4


@pytest.mark.parametrize("line", ['A,one,"1,234"', "A,one,12.5", "A,one,-", "A,one"])
def test_a_bad_cell_is_not_silently_missing(spark, tmp_path, line):
    write(tmp_path / "a.csv", f"code,name,n\nB,two,2\n{line}\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_csv(spark, str(tmp_path), SCHEMA).collect()
    assert as_set(read_csv(spark, str(tmp_path), SCHEMA, lineage=None, on_bad_cell="null")) == {
        ("A", "one", None),
        ("B", "two", 2),
    }


def test_code_of_a_typed_read_is_short_enough_to_be_compiled(spark, tmp_path):
    names = [f"c{i}" for i in range(24)]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(["12.0", "1e3", " 7 ", "NA"] * 6) + "\n")
    df = read_csv(spark, str(tmp_path), T.StructType([T.StructField(n, T.LongType()) for n in names]), lineage=None)
    assert list(df.first()) == [12, 1000, 7, None] * 6
    code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    # The JVM compiles no method of more than 8,000 bytes.
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)), default=0) < 8000


@pytest.mark.parametrize("kind", ["bigint", "int", "double", "date", "boolean", "decimal(9,2)"])
def test_a_bad_cell_of_each_type(spark, tmp_path, kind):
    (tmp_path / "a.csv").write_text("k,v\na,12.5.0\nb,NA\n")
    schema = T.StructType.fromDDL(f"k string, v {kind}")
    with pytest.raises(Exception, match="malformed cell of column v"):
        read_csv(spark, str(tmp_path), schema, lineage=None).collect()
    read = read_csv(spark, str(tmp_path), schema, lineage=None, on_bad_cell="null")
    assert sorted(map(tuple, read.collect())) == [("a", None), ("b", None)]


def test_rows_can_be_chosen_in_the_scan(spark, tmp_path):
    write(tmp_path / "a.csv", 'code,n\n A ,1\nAB,2\n" A",3\nB,4\n,5\n')
    write(tmp_path / "b.csv", "n\n6\n")
    got = read_csv(spark, str(tmp_path), SCHEMA, lineage=None, where={"code": "A"})
    assert {r.n for r in got.collect()} == {1, 3}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(code,A)" in plan


def test_clean_headers_and_repeats(spark, tmp_path):
    write(tmp_path / "a.csv", "Total,total,Total All\n1,2,3\n")
    assert as_set(read_csv(spark, str(tmp_path), clean=True, lineage=None)) == {("1", "2", "3")}
    assert read_csv(spark, str(tmp_path), clean=True, lineage=None).columns == ["total", "total_2", "total_all"]
    assert read_csv(spark, str(tmp_path), lineage=None).columns == ["Total", "total...2", "Total All"]


def test_padded_and_odd_headers(spark, tmp_path):
    write(tmp_path / "a.csv", '" code ", n ,NA,,\n" A ",1,x,y,z\n')
    assert as_set(read_csv(spark, str(tmp_path), SCHEMA, lineage=None)) == {("A", None, 1)}
    assert read_csv(spark, str(tmp_path), lineage=None).columns == ["code", "n", "NA", "...4", "...5"]


def test_a_file_that_arrives_with_another_layout_is_noticed(spark, tmp_path):
    write(tmp_path / "a.csv", "code,n\nA,1\n")
    planned = read_csv(spark, str(tmp_path / "*.csv"), SCHEMA)
    write(tmp_path / "a.csv", "n,code\n1,A\n")
    with pytest.raises(Exception, match="header"):
        planned.collect()


def test_no_file_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), SCHEMA)


def test_headers_and_schema_check(spark, tmp_path):
    write(tmp_path / "a.csv", '"Org, Code",Name\n1,2\n')
    write(tmp_path / "b.csv", "Name,Extra,Other\n" + "1,2,3\n" * 5)
    headers = read_headers(spark, str(tmp_path))
    assert as_set(column_counts(headers)) == {("a.csv", 2), ("b.csv", 3)}
    write(tmp_path / "again" / "a.csv", "Name\n1\n")
    both = read_headers(spark, str(tmp_path))
    assert as_set(column_counts(both)) == {("a.csv", 2), ("b.csv", 3), ("a.csv", 1)}
    assert as_set(schema_presence(both).filter("files_present > 1")) == {("Name", 3)}
    assert [tuple(r) for r in schema_presence(headers).collect()] == [
        ("Extra", 1),
        ("Org, Code", 1),
        ("Other", 1),
        ("Name", 2),
    ]


def test_listing_lineage_and_stacking(spark, tmp_path):
    write(tmp_path / "a.csv", "code\nA\n")
    write(tmp_path / "deep" / "b.csv", "code\nB\n")
    assert as_set(list_sources(spark, str(tmp_path)).select("file")) == {("a.csv",)}
    assert as_set(list_sources(spark, str(tmp_path), recursive=True).select("file")) == {("a.csv",), ("b.csv",)}
    assert list_sources(spark, str(tmp_path / "absent")).count() == 0
    scans = [
        with_lineage(spark.read.schema("code string").option("header", True).csv(str(p)))
        for p in (tmp_path / "a.csv", tmp_path / "deep")
    ]
    both = stack_files([scans[0], scans[1].withColumnRenamed("code", "other")])
    assert as_set(both) == {("A", "a.csv", None), (None, "b.csv", "B")}


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", True, None, dt.date(2026, 4, 1)), (None, None, 0.5, None)], "s string, b boolean, d double, m date"
    )
    write_csv(df.coalesce(1), f"{tmp_path}/out.csv")
    lines = sorted(next((tmp_path / "out.csv").glob("part-*.csv")).read_text().splitlines())
    assert lines == ["NA,NA,0.5,NA", "a,TRUE,NA,2026-04-01", "s,b,d,m"]
    schema = T.StructType([*df.schema.fields])
    assert as_set(read_csv(spark, f"{tmp_path}/out.csv", schema, lineage=None)) == as_set(df)


def test_hand_off_keeps_types(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2026, 4, 1), 1, "x"), (None, 2, None)], "report_month date, n long, s string")
    back = save_table(df, f"{tmp_path}/t", ["report_month"])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert as_set(back) == as_set(df)
    assert set(load_table(spark, f"{tmp_path}/t").columns) == set(df.columns)


def test_export_check(spark, tmp_path):
    write_csv(spark.range(3), f"{tmp_path}/a.csv")
    write(tmp_path / "b.csv", "x\n")
    assert as_set(export_check(spark, ["a.csv", "b.csv", "c.csv"], str(tmp_path))) == {
        ("a.csv", True),
        ("b.csv", True),
        ("c.csv", False),
    }
    assert as_set(export_check(spark, ["a.csv"], f"{tmp_path}/absent")) == {("a.csv", False)}


def test_archives(spark, tmp_path):
    write_zip(
        tmp_path / "one.zip",
        {"__MACOSX/._a.csv": "junk", "_b/c.csv": "code,n\nD,4\n", "a.csv": "code,n\nA,1\n", "deep/er/b.csv": "n,code\n2,B\n", "deep/notes.txt": "skip", "../up.csv": "code,n\nU,9\n"},
    )
    write_zip(tmp_path / "two.zip", {"a.csv": "code,n\nC,3\n"})
    assert as_set(zip_catalogue(spark, str(tmp_path))) == {
        ("one.zip", "__MACOSX/._a.csv", 4),
        ("one.zip", "_b/c.csv", 11),
        ("one.zip", "a.csv", 11),
        ("one.zip", "deep/er/b.csv", 11),
        ("one.zip", "deep/notes.txt", 4),
        ("one.zip", "../up.csv", 11),
        ("two.zip", "a.csv", 11),
    }
    got = read_zip_csv(spark, str(tmp_path), SCHEMA, stage=f"{tmp_path}/stage")
    assert as_set(got) == {
        ("A", None, 1, "a.csv"),
        ("B", None, 2, "b.csv"),
        ("C", None, 3, "a.csv"),
        ("D", None, 4, "c.csv"),
        ("U", None, 9, "up.csv"),
    }
    assert not (tmp_path / "up.csv").exists()


def test_large_member_is_copied_whole(spark, tmp_path):
    lines = "".join(f"{i},{'x' * 40}\n" for i in range(300_000))
    write_zip(tmp_path / "big.zip", {"big.csv": "n,code\n" + lines})
    got = read_zip_csv(spark, str(tmp_path), SCHEMA)
    assert got.count() == 300_000 and got.agg({"n": "sum"}).first()[0] == 300_000 * 299_999 // 2


def test_a_member_spark_would_skip_is_an_error(spark, tmp_path):
    write_zip(tmp_path / "one.zip", {"_a.csv": "code,n\nA,1\n"})
    with pytest.raises(Exception, match="starts with '_'"):
        read_zip_csv(spark, str(tmp_path), SCHEMA)


def test_a_repeated_or_broken_copy_leaves_one_whole_file(tmp_path):
    filesystem, root = _tasks.open_filesystem(f"file:{tmp_path}")

    class Broken(io.BytesIO):
        def read(self, size=-1):
            if self.tell():
                raise OSError("connection lost")
            return super().read(3)

    target = f"{root}/deep/a.csv"
    with pytest.raises(OSError):
        _tasks.copy_whole(Broken(b"code,n"), filesystem, target)
    assert [p.name[0] for p in (tmp_path / "deep").iterdir()] == ["."]  # hidden from Spark's readers
    for _ in range(2):
        assert _tasks.copy_whole(io.BytesIO(b"code,n\n"), filesystem, target) == 7
    assert (tmp_path / "deep" / "a.csv").read_text() == "code,n\n"


def test_a_cluster_without_a_shared_folder_is_an_error():
    conf = SimpleNamespace(get=lambda name, default: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local[8]"
    assert shared_root(SimpleNamespace(conf=conf, sparkContext=context))


def test_stage_is_the_configured_folder(spark):
    assert new_stage(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
