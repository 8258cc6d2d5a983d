"""CSV scans: file listing, header checks, reading by column name, lineage, stacking."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import quoted
from ..functions.names import unique_clean_names
from ..functions.text import base_name, missing_text, plain_path
from . import _tasks
from .staging import new_stage

Paths = str | Sequence[str]

# How the CSV files are written.
CSV_DIALECT = {"header": True, "nullValue": "NA", "quote": '"', "escape": '"', "encoding": "UTF-8"}
CSV_READ = {
    **CSV_DIALECT,
    "emptyValue": "NA",  # a quoted blank cell is missing too
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}

# A map from files to layouts is broadcast only if it was counted and is no larger than this.
BROADCAST_BYTES = 32 << 20

# Signs with a meaning in the paths Spark is given.
GLOB_SIGNS = re.compile(r"[\[\]{}*?\\]")


def list_sources(spark: SparkSession, paths: Paths, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(path, file) of the files under ``paths`` whose name matches a glob. Contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", recursive)
    try:
        found = reader.load(paths if isinstance(paths, str) else list(paths)).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.range(0).select(F.lit("").alias("path"))
    return found.select("path", base_name("path").alias("file"))


def file_manifest(spark: SparkSession, paths: Paths, pattern: str = "*.csv", recursive: bool = True) -> DataFrame:
    """(path, header, digest) of the files, stored: each file is opened once, for its first line only, however many
    reads, checks and reports use the manifest."""
    listing = list_sources(spark, paths, pattern, recursive).select("path")
    rows = listing.mapInPandas(_tasks.header_rows, "path string, header array<string>")
    rows = rows.withColumn("digest", F.sha2(F.to_json("header"), 256))
    folder, schema = new_stage(spark, "manifest"), rows.schema
    rows.write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def read_headers(
    spark: SparkSession, paths: Paths, pattern: str = "*.csv", recursive: bool = True, manifest: DataFrame | None = None
) -> DataFrame:
    """(path, file, position, column_name) of every column of every file; reads first lines only, or none with a
    ``manifest``."""
    manifest = file_manifest(spark, paths, pattern, recursive) if manifest is None else manifest
    cells = manifest.select("path", base_name("path").alias("file"), F.posexplode("header"))
    return cells.select("path", "file", F.col("pos").alias("position"), F.trim("col").alias("column_name"))


def column_counts(headers: DataFrame) -> DataFrame:
    """(file, column_count): how wide each file is; files of the same name in two folders are two rows."""
    return headers.groupBy("path", "file").agg(F.count(F.lit(1)).alias("column_count")).drop("path")


def with_lineage(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the base name of the file each row came from; apply directly on a file scan."""
    return df.withColumn(name, plain_path("_metadata.file_name"))


def stack_files(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _path_key(path: Column) -> Column:
    """A path as listings and scans both spell it: they differ in the slashes after ``file:``."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def files_with_breaks(spark: SparkSession, paths: Paths, pattern: str = "*.csv", recursive: bool = True) -> DataFrame:
    """(path) of the files in which a quoted cell may go on behind a line break: some line has an odd number of quotes.
    The pass over the lines is split like any text scan, and a file is at most one row of it."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    lines = reader.text(paths if isinstance(paths, str) else list(paths))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return lines.filter(quotes % 2 == 1).select(_path_key(plain_path("_metadata.file_path")).alias("path")).distinct()


def typed_cell(text: Column, kind: T.DataType, name: str, on_bad_cell: str = "fail") -> Column:
    """The value of a cell of its declared type; what is not of it stops the job, or is null with ``"null"``. A count may
    also be written as ``12.0`` or ``1e3``.

    What a plain cast does not read is looked at in an array of one, which is not part of the generated code: with it
    inline, a dozen columns make a method too long for the JVM to compile.
    """
    if isinstance(kind, T.StringType):
        return text

    def other(cell: Column) -> Column:
        found = []
        if isinstance(kind, T.IntegralType):
            number = cell.try_cast("decimal(38,6)")
            found.append(F.when(number == F.floor(number), number.try_cast(kind)))
        if on_bad_cell != "null":
            message = F.concat(F.lit(f"malformed cell of column {name}, no {kind.simpleString()}: "), cell)
            found.append(F.raise_error(message).cast(kind))
        return F.coalesce(*found) if found else F.lit(None).cast(kind)

    return F.coalesce(text.try_cast(kind), F.when(text.isNotNull(), F.transform(F.array(text), other)[0]))


@dataclass(frozen=True)
class _Layout:
    """The columns of the files of one header line: headings that Spark can tell apart, and names."""

    digest: str
    headings: tuple[str, ...]
    names: tuple[str, ...]
    checked: bool  # whether Spark can compare the headings itself


def _layouts(manifest: DataFrame, clean: bool) -> list[_Layout]:
    found = []
    for digest, header in sorted(manifest.filter(F.size("header") > 0).select("digest", "header").distinct().collect()):
        headings = _unique(header)
        names = unique_clean_names(header) if clean else headings
        found.append(_Layout(digest, tuple(headings), tuple(names), headings == list(header) and "NA" not in headings))
    return found


def read_csv(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType | None = None,
    *,
    clean: bool = False,
    keep_extra: bool = False,
    pattern: str = "*.csv",
    recursive: bool = True,
    lineage: str | None = "source_file",
    multiline: bool | None = None,
    where: Mapping[str, str] | None = None,
    on_bad_cell: str = "fail",
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Read header CSVs by column **name**, whatever the column order of each file.

    Spark binds CSV columns by position. So the headers are read first (first lines only, or not at all with a
    ``manifest``), and the files are scanned as text cells, one scan for all files of one width. If they have one
    layout, its columns are read alone; else each row picks its cells by the positions of its file's layout, so
    the plan does not grow with the number of layouts.
    Files in which a quoted cell may go on behind a line break are found by a first pass over the lines, and are
    scanned whole, a file a task; all others are split. ``multiline`` true or false says so without that pass.
    Declared columns a layout lacks are null; undeclared ones are dropped unless ``keep_extra``.
    ``clean`` matches the schema against cleaned names. Without a schema everything is text.
    Blank cells and ``NA`` are null, and text is trimmed; counts may be written as ``12.0`` or ``1e3``. ``where`` keeps
    rows whose text columns equal the given values; a weaker test goes into the scan.
    A row of another width than its header, or a cell that is not of its declared type, stops the
    job, as a count that silently turned missing would be left out of sums; with
    ``on_bad_cell="null"`` such cells are null.
    """
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_bad_cell]
    manifest = file_manifest(spark, paths, pattern, recursive) if manifest is None else manifest
    layouts = _layouts(manifest, clean)
    if not layouts:
        raise ValueError(f"no {pattern} file with a header under {paths}")
    files = manifest.filter(F.size("header") > 0).select(_path_key(F.col("path")).alias("path"), "digest", F.size("header").alias("width"))
    if multiline is None:
        breaks = files_with_breaks(spark, paths, pattern, recursive).withColumn("breaks", F.lit(True))
        files = files.join(breaks, "path", "left").fillna(False, ["breaks"])
    else:
        files = files.withColumn("breaks", F.lit(multiline))
    files = _stored_files(files)
    groups = sorted(tuple(r) for r in files.select("width", "breaks").distinct().collect())

    declared = {f.name: f.dataType for f in schema.fields} if schema else {}
    every = list(dict.fromkeys(n for layout in layouts for n in layout.names))
    wanted = [*declared, *(n for n in every if n not in declared and (keep_extra or not schema))]
    scans = []
    for width, breaks in groups:
        mine = [layout for layout in layouts if len(layout.names) == width]
        headings = mine[0].headings if len(mine) == 1 else [f"c{i}" for i in range(width)]
        scan_schema = T.StructType([T.StructField(h, T.StringType()) for h in headings])
        reader = spark.read.schema(scan_schema).options(**CSV_READ, mode=mode, multiLine=breaks)
        # With one layout each file is checked once more when it is read, where Spark can compare headings.
        reader = reader.option("enforceSchema", len(layouts) > 1 or not mine[0].checked)
        if len(groups) == 1:
            reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
            raw = reader.csv(paths if isinstance(paths, str) else list(paths))
        else:
            # File names only; Spark's own file index keeps the same list on the driver.
            names = [r.path for r in files.filter((F.col("width") == width) & (F.col("breaks") == breaks)).select("path").collect()]
            raw = reader.csv([GLOB_SIGNS.sub(r"\\\g<0>", p) for p in names])
        for n, value in (where or {}).items():
            # The exact test comes after trimming; this weaker one can be pushed into the scan.
            places = sorted({layout.names.index(n) for layout in mine if n in layout.names})
            raw = raw.filter(reduce(or_, [quoted(headings[p]).contains(value) for p in places], F.lit(False)))
        cells = _cells(raw, files, mine, wanted, list(headings), lineage)
        columns = [typed_cell(missing_text(cells[n]), declared.get(n, T.StringType()), n, on_bad_cell).alias(n) for n in wanted]
        if lineage:
            columns.append(plain_path(cells[None]).alias(lineage))
        scans.append(cells["rows"].select(*columns))
    out = stack_files(scans)
    for n, value in (where or {}).items():
        out = out.filter(quoted(n) == value)
    return out


def _stored_files(files: DataFrame) -> DataFrame:
    folder, schema = new_stage(files.sparkSession, "files"), files.schema
    files.write.parquet(folder)
    return files.sparkSession.read.schema(schema).parquet(folder)


def _cells(raw: DataFrame, files: DataFrame, layouts: Sequence[_Layout], wanted: Sequence[str], headings: list[str], lineage) -> dict:
    """The text of each wanted column, at ``None`` the file's name, and at ``"rows"`` the frame these columns are of."""
    missing, spark = F.lit(None).cast("string"), raw.sparkSession
    name = F.col("_metadata.file_name")
    if len(layouts) == 1:
        place = {n: i for i, n in enumerate(layouts[0].names)}
        return {n: quoted(headings[place[n]]) if n in place else missing for n in wanted} | {None: name, "rows": raw}
    rows = [(layout.digest, [layout.names.index(n) if n in layout.names else None for n in wanted]) for layout in layouts]
    places = literal_rows(spark, rows)
    # Kilobytes for each file; beyond the bound Spark shuffles the rows by file, and splits large ones.
    known = _stored_files(files.join(places, "digest").select(F.col("path").alias("__path"), "__places"))
    if known.count() * (200 + 4 * len(wanted)) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    packed = raw.select(F.array(*[quoted(h) for h in headings]).alias("__cells"), _path_key(plain_path("_metadata.file_path")).alias("__path"), name.alias("__name"))
    packed = packed.join(known, "__path")
    found = {n: F.get("__cells", F.get("__places", F.lit(i))) for i, n in enumerate(wanted)}
    return found | {None: F.col("__name"), "rows": packed}


def literal_rows(spark: SparkSession, rows: list[tuple[str, list]]) -> DataFrame:
    return spark.createDataFrame(rows, "digest string, __places array<int>")


def _unique(layout: Sequence[str]) -> list[str]:
    """Header names, trimmed; blank or repeated ones get their position appended."""
    seen: set[str] = set()
    out = []
    for position, name in enumerate(map(str.strip, layout), start=1):
        # Spark compares names without regard to case.
        if not name or name.lower() in seen:
            name = f"{name}...{position}"
        seen.add(name.lower())
        out.append(name)
    return out

