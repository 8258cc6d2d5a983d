"""Column profiles of wide tables, in few passes.

Profiles read every column they describe, so on text sources stage the table as Parquet first
(``sources.save_table``): each profile then scans only its own columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import quoted
from ..functions.names import columns_of_type
from ..sources.files import column_counts
from ..sources.sinks import literal_table, write_csv
from .aggregates import count_by
from .joins import Keys, as_list
from .ordering import order
from .reshape import stack, stats_to_long, wide_to_long

# Type labels of the published type profile.
TYPE_LABELS = {
    T.StringType: "character",
    T.BooleanType: "logical",
    T.DateType: "Date",
    T.TimestampType: "POSIXct",
    T.TimestampNTZType: "POSIXct",
    T.NumericType: "numeric",
}


# Columns whose statistics one generated method can hold and still be compiled.
PER_SCAN = 16


def schema_presence(headers: DataFrame) -> DataFrame:
    """(column_name, files_present), rarest first, from the rows of ``read_headers``."""
    pairs = headers.select("path", "column_name").distinct()
    return order(count_by(pairs, "column_name", "files_present"), "files_present", "column_name")


def _place(name: str, columns: Sequence[str]) -> Column:
    """Position of a column name in a table, to sort report rows by."""
    return F.array_position(F.array(*map(F.lit, columns)), F.col(name))


def _cells(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(__place, __value) of every cell. Rows group faster by a column's place than by its name."""
    values = F.array(*[quoted(c).cast(dtype) for c in columns]).cast(f"array<{dtype}>")
    return df.select(F.posexplode(values).alias("__place", "__value"))


def _no_cells(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """A null per column, so that an empty table still yields its columns."""
    return literal_table(df.sparkSession, [(i, None) for i in range(len(columns))], f"__place int, __value {dtype}")


def _named(out: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The column's name in place of its position."""
    names = F.array(*map(F.lit, columns)).cast("array<string>")
    return out.select(names[F.col("__place")].alias(name), *[c for c in out.columns if c != "__place"])


def _scans(columns: Sequence[str], per_scan: int) -> list[list[str]]:
    return [list(columns[i : i + per_scan]) for i in range(0, len(columns), per_scan)]


def missing_profile(df: DataFrame, per_scan: int = PER_SCAN) -> DataFrame:
    """(column_name, missing_count, missing_pct), most missing first, ties in column order.

    ``per_scan`` as in ``numeric_profile``.
    """
    parts = []
    for columns in _scans(df.columns, per_scan):
        present = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(quoted(c)).alias(c) for c in columns])
        parts.append(wide_to_long(present, "column_name", "__present", ids=["__rows"]))
    missing = F.col("__rows") - F.col("__present")
    pct = F.when(F.col("__rows") > 0, F.bround(missing / F.col("__rows") * 100, 2))
    out = stack(*parts).select("column_name", missing.alias("missing_count"), pct.alias("missing_pct"))
    return out.orderBy(F.desc("missing_count"), _place("column_name", df.columns))


# Statistics of a numeric column.
NUMERIC_STATS = {
    "min": F.min,
    "max": F.max,
    "zero_count": lambda v: F.count_if(v == 0),
    "negative_count": lambda v: F.count_if(v < 0),
}


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, per_scan: int = PER_SCAN) -> DataFrame:
    """(metric, min, max, zero_count, negative_count) of numeric columns, in column order.

    ``per_scan`` says how many columns one scan takes. Of a wide table stored by column, narrow scans
    read the same bytes in total and run several times faster, as the JVM compiles code for a few columns
    to machine code but not code for a hundred. Store a table of text or a derived one first.
    Columns share one type: bigint if all are whole-number columns, else double.
    """
    columns = list(columns or columns_of_type(df, "numeric"))
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    dtype = "bigint" if whole else "double"
    if not columns:
        return df.sparkSession.createDataFrame([], f"metric string, min {dtype}, max {dtype}, zero_count bigint, negative_count bigint")
    values = df.select(*[quoted(c).cast(dtype).alias(c) for c in columns])
    scans = [(values.select(*map(quoted, part)), part) for part in _scans(columns, per_scan)]
    out = stack(*[stats_to_long(narrow, part, NUMERIC_STATS) for narrow, part in scans])
    return out.orderBy(_place("metric", columns))


def character_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, distinct_values) of text columns, most first, ties in column order.

    A missing value counts as one.

    Values are made distinct per (column, value), which spreads the work over values and combines
    repeats inside each task, rather than by one expanding distinct count per column. Long values
    travel as digests.
    """
    columns = list(columns or columns_of_type(df, "character"))
    short = df.select(*[short_value(quoted(c)).alias(c) for c in columns])
    counts = count_by(_cells(short, columns, "string").distinct(), "__place", "distinct_values")
    none = _no_cells(df, columns, "string").select("__place", F.lit(0).cast("bigint").alias("distinct_values"))
    out = stack(counts, none).groupBy("__place").agg(F.max("distinct_values").alias("distinct_values"))
    return _named(out.orderBy(F.desc("distinct_values"), "__place"), columns, "column_name")


def type_label(dtype: T.DataType) -> str:
    for kind, label in TYPE_LABELS.items():
        if isinstance(dtype, kind):
            return label
    return dtype.simpleString()


def type_profile(df: DataFrame, spark_names: bool = False) -> DataFrame:
    """(column_name, data_type) from the schema, as profile labels or as Spark type names."""
    rows = [(f.name, f.dataType.simpleString() if spark_names else type_label(f.dataType)) for f in df.schema.fields]
    return literal_table(df.sparkSession, rows, "column_name string, data_type string")


def short_value(col: Column) -> Column:
    """The text itself up to 64 bytes, else its SHA-256 digest.

    A digest gets a sign in front, which makes it longer than any text kept as it is.
    """
    return F.when(F.octet_length(col) > 64, F.concat(F.lit("#"), F.sha2(col, 256))).otherwise(col)


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the values of a row, the same for rows that ``GROUP BY`` would put together."""

    def stable(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return value + F.lit(0.0)  # turns -0.0 into 0.0
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(value)  # local time repeats an hour when clocks change
        if isinstance(kind, T.BinaryType):
            return F.hex(value)
        if isinstance(kind, T.StringType):
            return F.hex(value.cast("binary"))  # bytes that are no text stay apart
        if isinstance(kind, (T.DatetimeType, T.DecimalType)):
            return value.cast("string")
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda x: stable(x, kind.elementType))
        if isinstance(kind, T.StructType):
            inner = F.struct(*[stable(value.getField(f.name), f.dataType).alias(f"_{i}") for i, f in enumerate(kind.fields)])
            return F.when(value.isNotNull(), inner)
        return value

    values = F.struct(*[stable(quoted(c), df.schema[c].dataType).alias(f"_{i}") for i, c in enumerate(columns)])
    return F.sha2(F.to_json(values, {"ignoreNullFields": "false"}), 256)


# Types a text column may turn out to have, in order of preference, with the test each value must pass.
GUESSES = {
    "logical": lambda v: F.upper(v).isin("T", "F", "TRUE", "FALSE"),
    # A code with leading zeros is no number.
    "numeric": lambda v: v.rlike(r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"),
    "Date": lambda v: v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull(),
}
GUESSED_TYPES = {"logical": "boolean", "numeric": "double", "Date": "date", "character": "string"}


def guess_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type, present) of text columns by what all their values look like, in one pass.

    A column without any value counts as logical.
    """
    columns = columns_of_type(df, "character")
    v = F.col("__value")
    tests = [F.bool_and(F.when(v.isNotNull(), test(v))).alias(label) for label, test in GUESSES.items()]
    cells = stack(_cells(df, columns, "string"), _no_cells(df, columns, "string"))
    seen = cells.groupBy("__place").agg(F.count(v).alias("present"), *tests)
    passed = [F.when(F.coalesce(label, F.lit(True)), F.lit(label)) for label in GUESSES]
    out = seen.select("__place", F.coalesce(*passed, F.lit("character")).alias("data_type"), "present")
    return _named(out.orderBy("__place"), columns, "column_name")


def guess_schema(df: DataFrame) -> T.StructType:
    """A schema for ``read_csv`` from a table read as text. Runs one pass; one row per column is collected."""
    kinds = {r.column_name: GUESSED_TYPES[r.data_type] for r in guess_types(df).collect()}
    return T.StructType([T.StructField(n, T.StructType.fromDDL(f"x {t}")[0].dataType) for n, t in kinds.items()])


def exact_duplicates(df: DataFrame, keys: Keys | None = None, digest: bool = False) -> DataFrame:
    """One row: how many rows equal an earlier row on ``keys`` (default: all columns).

    Copies are combined inside each task before they are shuffled. With ``digest``, for wide rows or
    long texts, rows are shuffled as 32-byte digests instead of whole; equality is then up to collision.
    """
    columns = as_list(keys or df.columns)
    by = [F.unhex(row_digest(df, columns)).alias("__digest")] if digest else [quoted(c) for c in columns]
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    extra = F.coalesce(F.sum(F.col("__n") - 1), F.lit(0))
    return groups.agg(extra.alias("exact_duplicates"))


def profile_report(
    df: DataFrame, headers: DataFrame, file_col: str = "source_file", per_scan: int = PER_SCAN
) -> Mapping[str, DataFrame]:
    """The seven profile tables by name. Write them with ``write_report``.

    ``per_scan`` as in ``numeric_profile``.
    """
    return {
        "column_counts": order(column_counts(headers), "file"),
        "schema_check": schema_presence(headers),
        "missing_profile": missing_profile(df, per_scan),
        "type_profile": type_profile(df),
        "numeric_profile": numeric_profile(df, per_scan=per_scan),
        "rows_by_file": order(count_by(df, file_col, "rows"), file_col),
        "character_profile": character_profile(df),
    }


def write_report(tables: Mapping[str, DataFrame], folder: str, prefix: str = "") -> list[str]:
    """Write report tables as ``<folder>/<prefix><name>.csv`` and return the file names."""
    names = []
    for name, table in tables.items():
        names.append(f"{prefix}{name}.csv")
        write_csv(table, f"{folder}/{names[-1]}")
    return names
