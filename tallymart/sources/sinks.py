"""Sinks: CSV exports, Parquet hand-off between stages, presence checks, small literal tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import quoted
from .files import CSV_DIALECT, list_sources


# Spark's writer trims text unless told not to.
UNTRIMMED = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Header CSV with ``NA`` for missing cells and ``TRUE`` / ``FALSE`` for booleans.

    The result is a folder of part files, written in parallel.
    """
    columns = [
        F.upper(quoted(f.name).cast("string")).alias(f.name) if isinstance(f.dataType, T.BooleanType) else quoted(f.name)
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode("overwrite").options(**CSV_DIALECT, **UNTRIMMED).partitionBy(*partition_by).csv(path)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and return the table read back, which also cuts the lineage.

    With partition columns, rows are first rebalanced on them: Spark gathers small partitions into
    one file and splits a partition value that holds much of the data over several tasks.
    """
    schema = df.schema
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return load_table(df.sparkSession, path, schema)


def save_tables(tables: Mapping[str, DataFrame], folder: str, partition_by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Save independent tables as ``<folder>/<name>`` and return them read back. Their jobs run side by side, so that
    the last tasks of one do not keep the cluster waiting."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        saved = {n: pool.submit(inheritable_thread_target(t.sparkSession)(save_table), t, f"{folder}/{n}", partition_by) for n, t in tables.items()}
        return {n: done.result() for n, done in saved.items()}


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Bring new or corrected periods into a saved table and return it read back: the partitions that ``df`` has rows
    of are replaced, all others stay as they are and are not read. ``df`` must not come from the table itself."""
    schema = load_table(df.sparkSession, path).schema
    if set(schema.names) != set(df.columns):
        raise ValueError(f"columns {sorted(df.columns)} are not those of the table, {sorted(schema.names)}")
    typed = df.select(*[quoted(c).cast(schema[c].dataType).alias(c) for c in df.columns])
    writer = typed.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return load_table(df.sparkSession, path, typed.schema)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by ``save_table``; types come from the files, or from ``schema``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    out = reader.parquet(path)
    return out.select(*schema.names) if schema is not None else out


# Arrow types of the columns a literal table may have.
ARROW_TYPES = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
}


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small inline table, of which Spark knows the size."""
    fields = T.StructType.fromDDL(schema).fields
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), ARROW_TYPES[f.dataType.simpleString()]) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[f.name for f in fields]), schema)


def export_check(spark: SparkSession, names: Sequence[str], folder: str) -> DataFrame:
    """(file_name, exists): which expected files, or folders of part files, lie in ``folder``."""
    listing = list_sources(spark, folder, pattern="*", recursive=True)
    # The folder's own absolute path comes first in each listed path; its name may come again later.
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()
    path = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    inside = path.substr(F.lit(len(root.rstrip("/")) + 2), F.length(path))
    present = listing.select(F.split(inside, "/")[0].alias("file_name")).distinct()
    expected = literal_table(spark, [(n,) for n in names], "file_name string")
    found = present.withColumn("__found", F.lit(True))
    return expected.join(found, "file_name", "left").select(
        "file_name", F.coalesce("__found", F.lit(False)).alias("exists")
    )
