"""Sources and sinks, over files that Spark first writes from the given tables."""

from __future__ import annotations

import sys
import tempfile
import zipfile

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import plain_path
from tallymart.operators import count_by, guess_types, schema_presence
from tallymart.sources import (
    column_counts,
    export_check,
    list_sources,
    new_stage,
    read_csv,
    read_headers,
    read_zip_csv,
    replace_partitions,
    save_table,
    stack_files,
    with_lineage,
    write_csv,
    zip_catalogue,
)
from tallymart.sources._tasks import COPY_BYTES, copy_whole, open_filesystem
from tallymart.sources.files import CSV_READ

from .base import query, table

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("urgent", T.BooleanType()),
    ]
)

_ORDERS_SQL = """SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
  o_orderpriority = '1-URGENT' AS urgent, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"""


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_custkey"), F.lit(7)).alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.year("o_orderdate").alias("year"),
    )


def write_drifted(spark, sf_dir, label):
    """CSV folders of one table whose layout changes in 1998: other column order, no priority."""
    stage = new_stage(spark, label)
    rows = orders(spark, sf_dir)
    write_csv(rows.filter("year < 1998"), f"{stage}/old", ["year"])
    newer = ["o_orderdate", "urgent", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey", "year"]
    write_csv(rows.filter("year >= 1998").select(*newer), f"{stage}/new", ["year"])
    return stage


@query(
    "csv_round_trip",
    "S2 S5 S8 S9 S10 X12",
    f"""SELECT * EXCLUDE (year) REPLACE (CASE WHEN year < 1998 THEN o_orderpriority END AS o_orderpriority),
  TRUE AS has_source FROM ({_ORDERS_SQL})""",
)
def csv_round_trip(spark, sf_dir):
    back = read_csv(spark, write_drifted(spark, sf_dir, "csv"), ORDER_SCHEMA)
    return back.withColumn("has_source", F.col("source_file").endswith(".csv")).drop("source_file")


@query(
    "csv_line_breaks",
    "S5 S10",
    """SELECT doc_id, lang, sha256(t) AS text_sha256, CAST(length(t) AS BIGINT) AS text_length
FROM (SELECT doc_id, lang, nullif(nullif(trim(text), ''), 'NA') AS t FROM documents)""",
)
def csv_line_breaks(spark, sf_dir):
    """Texts with line breaks and quotes inside, written as CSV by language and read back."""
    stage = f"{new_stage(spark, 'breaks')}/texts"
    texts = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.col("lang").alias("folder"))
    write_csv(texts, stage, ["folder"])
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string")
    back = read_csv(spark, stage, schema, lineage=None)
    return back.select(
        "doc_id", "lang", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.length("text").cast("bigint").alias("text_length")
    )


_GUESSED = {
    "o_orderkey": ("numeric", "o_orderkey"),
    "o_custkey": ("numeric", "nullif(o_custkey, 7)"),
    "o_orderstatus": ("character", "o_orderstatus"),
    "o_totalprice": ("numeric", "o_totalprice"),
    "o_orderdate": ("Date", "o_orderdate"),
    "o_orderpriority": ("character", "CASE WHEN year(o_orderdate) < 1998 THEN nullif(o_orderpriority, '5-LOW') END"),
    "urgent": ("logical", "o_orderpriority"),
}


@query(
    "guess_types",
    "S5 A10 X20",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({e}) AS present FROM orders"
        for c, (t, e) in _GUESSED.items()
    ),
)
def guess_types_(spark, sf_dir):
    """Types guessed from CSV text, as there is no schema."""
    return guess_types(read_csv(spark, write_drifted(spark, sf_dir, "guess"), keep_extra=True, lineage=None))


def _headers_by_year(spark, sf_dir):
    """Headers with the folder in place of the file, as how many files a folder holds is up to Spark."""
    headers = read_headers(spark, write_drifted(spark, sf_dir, "headers"))
    folder = F.element_at(F.split("path", "/"), -2)
    return headers.select(folder.alias("path"), folder.alias("file"), "column_name", "position").distinct()


_HEADERS_SQL = """headers AS (
  SELECT DISTINCT 'year=' || year(o_orderdate) AS file, c AS column_name
  FROM orders, (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'),
    ('o_orderpriority'), ('urgent')) v(c)
  WHERE c <> 'o_orderpriority' OR year(o_orderdate) < 1998)"""


@query(
    "schema_presence",
    "S6 A6 UD2",
    f"WITH {_HEADERS_SQL} SELECT column_name, count(*) AS files_present FROM headers GROUP BY ALL",
)
def schema_presence_(spark, sf_dir):
    return schema_presence(_headers_by_year(spark, sf_dir))


@query(
    "column_counts",
    "S6 S7",
    f"WITH {_HEADERS_SQL} SELECT file, count(*) AS column_count FROM headers GROUP BY ALL",
)
def column_counts_(spark, sf_dir):
    return column_counts(_headers_by_year(spark, sf_dir))


@query(
    "rows_by_source",
    "S1 S2 S9 A1 X19",
    "SELECT 'year=' || year(o_orderdate) AS folder, count(*) AS n FROM orders GROUP BY ALL",
)
def rows_by_source(spark, sf_dir):
    """Rows per source file, summed per folder through the file listing."""
    stage = new_stage(spark, "sources")
    write_csv(orders(spark, sf_dir), stage, ["year"])
    reader = spark.read.schema(ORDER_SCHEMA).options(**CSV_READ).option("recursiveFileLookup", True)
    scan = reader.csv(stage)
    per_file = count_by(with_lineage(scan).withColumn("uri", plain_path("_metadata.file_path")), ["uri", "source_file"])
    listing = list_sources(spark, stage, recursive=True)
    by_path = listing.select(F.element_at(F.split("path", "/"), -2).alias("folder"), _local("path"), "file")
    # Part files of one write share a name between folders, so files are matched by path as well.
    matched = by_path.join(per_file.select(_local("uri"), F.col("source_file").alias("file"), "n"), ["local", "file"])
    return matched.groupBy("folder").agg(F.sum("n").alias("n"))


def _local(name):
    return F.regexp_replace(name, "^file:/+", "/").alias("local")


@query(
    "stage_hand_off",
    "S13 X12",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, o_orderstatus, count(*) AS n
FROM orders GROUP BY ALL""",
)
def stage_hand_off(spark, sf_dir):
    """A fact is saved by month and read back with its types."""
    rows = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("report_month"), "o_orderstatus")
    fact = count_by(rows, ["report_month", "o_orderstatus"])
    return save_table(fact, f"{new_stage(spark, 'hand-off')}/fact", ["report_month"])


@query(
    "month_hand_off",
    "S13 X6",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, o_orderstatus, count(*) AS n, TRUE AS untouched
FROM orders GROUP BY ALL""",
)
def month_hand_off(spark, sf_dir):
    """A fact that lacks its newest months, and has a wrong one, gets these alone: it equals the full build, and the
    files of all other months are the ones written before."""
    rows = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("report_month"), "o_orderstatus")
    fact = count_by(rows, ["report_month", "o_orderstatus"])
    path = f"{new_stage(spark, 'months')}/fact"
    late, wrong = F.col("report_month") >= "1998-01-01", F.col("report_month") == "1995-03-01"
    before = save_table(fact.filter(~late).withColumn("n", F.when(wrong, 0).otherwise(F.col("n"))), path, ["report_month"])
    kept = save_table(before.select("report_month", F.col("_metadata.file_name").alias("file")).distinct(), f"{path}-files")
    after = replace_partitions(fact.filter(late | wrong), path, ["report_month"])
    after = after.select("*", late.alias("late"), wrong.alias("wrong"), F.col("_metadata.file_name").alias("file"))
    known = kept.select(F.col("report_month").alias("m"), F.col("file").alias("f"), F.lit(True).alias("known"))
    found = after.join(known, (F.col("report_month") == F.col("m")) & (F.col("file") == F.col("f")), "left")
    same = F.coalesce("known", F.lit(False)) != (F.col("late") | F.col("wrong"))
    return found.select("report_month", "o_orderstatus", "n", same.alias("untouched"))


_EXPORTS = ["customer", "supplier", "part"]


@query(
    "export_check",
    "S10 S11 S12 U2",
    """SELECT 'customer.csv' AS file_name, TRUE AS exists, count(*) AS "rows" FROM customer
UNION ALL SELECT 'supplier.csv', TRUE, count(*) FROM supplier
UNION ALL SELECT 'part.csv', FALSE, NULL""",
)
def export_check_(spark, sf_dir):
    """Two of three expected exports are written; rows are counted in what was found."""
    stage = new_stage(spark, "exports")
    for name in _EXPORTS[:2]:
        write_csv(table(spark, sf_dir, name), f"{stage}/{name}.csv")
    checked = export_check(spark, [f"{n}.csv" for n in _EXPORTS], stage)
    counts = [
        count_by(read_csv(spark, f"{stage}/{n}.csv", lineage=None).select(F.lit(f"{n}.csv").alias("file_name")), "file_name", "rows")
        for n in _EXPORTS[:2]
    ]
    return checked.join(stack_files(counts), "file_name", "left")


# ---- Archives ----

ARCHIVE_ROWS = 1_000_000  # rows per CSV file, and so per archive member


def pack_rows(batches):
    """Put each CSV file into an archive of its own, next to a small note, named after its folder."""
    for batch in batches:
        packed = []
        for path in batch["path"]:
            filesystem, local = open_filesystem(path)
            folder, name = local.rsplit("/", 2)[-2:]
            target = f"{local.rsplit('/', 3)[0]}/zip/{folder}-{name.removesuffix('.csv')}.zip"
            with tempfile.TemporaryFile() as spool:
                with zipfile.ZipFile(spool, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("notes/readme.txt", "extract\n")
                    with filesystem.open_input_stream(local) as source, archive.open(f"extract/{name}", "w") as member:
                        while block := source.read(COPY_BYTES):
                            member.write(block)
                spool.seek(0)
                copy_whole(spool, filesystem, target)
            packed.append(target)
        yield pd.DataFrame({"archive": packed})


cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
HEADER_BYTES = len(",".join(ARCHIVE_COLUMNS)) + 1


def write_archives(spark, sf_dir, label):
    """Orders as ZIP archives of CSV, several per year."""
    stage = new_stage(spark, label)
    rows = table(spark, sf_dir, "orders").select(
        *ARCHIVE_COLUMNS[:3],
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
    )
    rows.write.option("header", True).option("maxRecordsPerFile", ARCHIVE_ROWS).partitionBy("year").csv(f"{stage}/csv")
    files = list_sources(spark, f"{stage}/csv", recursive=True).select("path")
    packed = files.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(pack_rows, "archive string")
    packed.write.parquet(f"{stage}/packed")
    return f"{stage}/zip"


@query(
    "zip_catalogue",
    "S3 UD2",
    """SELECT 'year=' || year(o_orderdate) AS folder, CAST(sum(1 + length(concat_ws(',', o_orderkey, o_custkey,
  o_orderstatus, CAST(o_orderdate AS DATE), o_orderpriority))) AS BIGINT) AS data_bytes FROM orders GROUP BY ALL""",
)
def zip_catalogue_(spark, sf_dir):
    """Uncompressed bytes of the archived lines per year, from the archives' directories alone."""
    members = zip_catalogue(spark, write_archives(spark, sf_dir, "catalogue")).filter(F.col("file_name").endswith(".csv"))
    return members.groupBy(F.substring("source_zip", 1, 9).alias("folder")).agg(
        F.sum(F.col("file_size") - HEADER_BYTES).alias("data_bytes")
    )


@query(
    "zip_read",
    "S4 S5 S9",
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders",
)
def zip_read(spark, sf_dir):
    archives = write_archives(spark, sf_dir, "archives")
    schema = T.StructType([ORDER_SCHEMA[c] for c in ARCHIVE_COLUMNS])
    return read_zip_csv(spark, archives, schema).drop("source_file")
