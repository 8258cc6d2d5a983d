"""Helpers of the training-data operators: stored intermediate tables, checked broadcasts, row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import quoted
from ..sources.staging import new_stage

# A side of a join is broadcast only if it was counted and holds no more than this.
BROADCAST_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and a lost executor
    costs no more than the tasks that ran on it."""
    path = new_stage(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored table for broadcast if it fits ``limit``; else Spark shuffles both sides. Its size is
    its counted rows times ``row_bytes`` or, without these, the length of its rows as JSON."""
    if row_bytes is None:
        size = df.select(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    else:
        size = df.count() * row_bytes
    return F.broadcast(df) if size <= limit else df


def schema_of(kinds: dict[str, T.DataType], ddl: str = "") -> T.StructType:
    """A schema of columns with known types, followed by those that ``ddl`` declares."""
    return T.StructType([*(T.StructField(n, k) for n, k in kinds.items()), *(T.StructType.fromDDL(ddl).fields if ddl else [])])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(name: str) -> Column:
    """The text of a row, with null as the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def same(left: Column, right: Column) -> Column:
    """Equality under which null equals null."""
    return left.eqNullSafe(right)


def crc_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")) % mod
