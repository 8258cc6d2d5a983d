"""ZIP archives of CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name
from . import _tasks
from .files import Paths, list_sources, read_csv
from .staging import new_stage

MEMBER_SCHEMA = "path string, position int, source_zip string, file_name string, file_size bigint"


def _members(spark: SparkSession, paths: Paths, pattern: str) -> DataFrame:
    return list_sources(spark, paths, pattern).select("path").mapInPandas(_tasks.member_rows, MEMBER_SCHEMA)


def zip_catalogue(spark: SparkSession, paths: Paths, pattern: str = "*.zip") -> DataFrame:
    """(source_zip, file_name, file_size) of every archive member."""
    return _members(spark, paths, pattern).drop("path", "position")


def unpack_archives(spark: SparkSession, paths: Paths, target: str, member: str = r"\.csv$", pattern: str = "*.zip") -> str:
    """Unpack members whose name matches ``member`` to ``target`` and return the folder they are in.

    The unit of work is a member, not an archive, so a large archive is spread over the cluster.
    The result is plain files on shared storage, which Spark can split when it reads them. Each member
    has a folder of its own, named after its archive's whole path and its place in the directory, so
    archives or members of one name do not meet. Stops if what was written is not what was listed.
    """
    hidden = base_name("file_name").startswith(".")
    chosen = _members(spark, paths, pattern).filter(F.col("file_name").rlike(member) & ~hidden)
    size = F.coalesce(F.sum("file_size"), F.lit(0)).alias("size")
    members, listed = chosen.agg(F.count(F.lit(1)), size).first()  # reads the archives' directories only
    if not members:
        raise ValueError(f"no member like {member} in {pattern} under {paths}")
    tasks = min(members, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    task = _tasks.unpack_rows(f"{target}/members")
    done = chosen.repartition(tasks, "path", "position").mapInPandas(task, MEMBER_SCHEMA)
    done.write.mode("overwrite").parquet(f"{target}/manifest")
    written = spark.read.parquet(f"{target}/manifest").agg(F.count(F.lit(1)), size).first()
    if tuple(written) != (members, listed):
        raise ValueError(f"unpacked {tuple(written)} members and bytes of {(members, listed)} under {paths}")
    return f"{target}/members"


def read_zip_csv(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType | None = None,
    *,
    stage: str | None = None,
    pattern: str = "*.zip",
    **options,
) -> DataFrame:
    """Unpack every archive and read all its CSV members as one table (options as in ``read_csv``)."""
    stage = stage or new_stage(spark, "unzip")
    return read_csv(spark, unpack_archives(spark, paths, stage, pattern=pattern), schema, **options)
