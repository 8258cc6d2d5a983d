"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters and sorted inside each partition, so equal texts lie
next to each other; each row is compared in full with its neighbour. The splitter key is the text's
first characters, a hash of the whole text, and the id: it keeps the driver's sample small and lets one
large group of copies spread over many partitions. Only the first and the last run of a partition can
go on in another one; those are matched by their whole texts, two per partition.

Null texts count as empty. Rows that have the same text and the same id are ties of which one stays.
Extra columns may have any name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import partitions, schema_of, stored, whole_text

LEAD = 16


def number_runs(heads_only: bool):
    """A task over sorted rows (body, ...): number the runs of equal bodies. ``edge`` holds the body of
    the first run's first row and, in one more row at the end, that of the last run. The body itself
    goes on with ``heads_only``, which passes the first row of each run alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, last = TaskContext.get().partitionId(), -1, None

        def packed(table: pa.RecordBatch, runs, head, edge, real) -> pa.RecordBatch:
            n = len(runs)
            names = [name for name in table.schema.names if heads_only or name != "body"]
            columns = [table.column(table.schema.names.index(name)) for name in names]
            columns += [pa.array(np.full(n, part, np.int64)), pa.array(runs), pa.array(head), edge, pa.array(np.full(n, real))]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "part", "run", "head", "edge", "real"])

        sample = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sample = batch.slice(0, 1)
            body = batch.column(batch.schema.names.index("body"))
            head = np.ones(n, bool)
            head[1:] = pc.not_equal(body[1:], body[:-1]).to_numpy(zero_copy_only=False)
            head[0] = last is None or body[0].as_py() != last
            runs = number + np.cumsum(head)
            mask = np.zeros(n, bool)
            mask[0] = last is None
            edge = pc.if_else(pa.array(mask), body, pa.scalar(None, body.type))
            number, last = int(runs[-1]), body[n - 1].as_py()
            out = packed(batch, runs.astype(np.int64), head, edge, True)
            yield out.filter(pa.array(head)) if heads_only else out
        if sample is not None:
            blank = pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in sample.schema], schema=sample.schema)
            yield packed(blank, np.array([number], np.int64), np.array([False]), pa.array([last], sample.schema.field("body").type), False)

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str, keep: str, columns: dict, heads_only: bool) -> DataFrame:
    rows = docs.select(
        whole_text(text_col).alias("body"), quoted(id_col).alias("id"), *[c.alias(n) for n, c in columns.items()]
    )
    rows = rows.withColumns({"lead": F.substring("body", 1, LEAD), "mixed": F.xxhash64("body")})
    first = F.col("id").desc_nulls_last() if keep == "max" else F.col("id").asc_nulls_last()
    spread = rows.repartitionByRange(partitions(docs.sparkSession), "lead", "mixed", first)
    spread = spread.sortWithinPartitions("lead", "mixed", "body", first).drop("lead", "mixed")
    passed = {f.name: f.dataType for f in spread.schema.fields if heads_only or f.name != "body"}
    schema = schema_of(passed, "part bigint, run bigint, head boolean, edge string, real boolean")
    return stored(spread.mapInArrow(number_runs(heads_only), schema), "exact")


def _homes(numbered: DataFrame) -> DataFrame:
    """(part, run, home) of the runs at partition edges: the first run with the same whole text."""
    edges = numbered.filter("edge IS NOT NULL").select("edge", "part", "run").distinct()
    firsts = edges.groupBy("edge").agg(F.min(F.struct("part", "run")).alias("home"))
    return edges.join(firsts, "edge").select("part", "run", "home")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per row of ``docs``: its id, keep_id (id of the row of its group that stays), group_size,
    kept, text_sha256. ``keep`` is "min" or "max": which id of equal texts stays, null ids last."""
    columns = {"sha": F.unhex(F.sha2(whole_text(text_col).cast("binary"), 256))}
    numbered = _numbered(docs, id_col, text_col, keep, columns, heads_only=False)
    own = F.struct("part", "run")
    rows = numbered.filter("real").drop("edge", "real").join(_homes(numbered), ["part", "run"], "left")
    rows = rows.withColumn("home", F.coalesce("home", own))
    best = F.max("id") if keep == "max" else F.min("id")
    # Stored, so that the join can split a group that holds many of the rows.
    groups = stored(rows.groupBy("home").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    return rows.join(groups, "home").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("head") & (F.col("home") == own)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    rest = F.struct(*[quoted(c) for c in docs.columns if c != text_col])
    columns = {"missing": quoted(text_col).isNull(), "rest": rest}
    numbered = _numbered(docs, id_col, text_col, keep, columns, heads_only=True)
    rows = numbered.filter("real").join(_homes(numbered), ["part", "run"], "left")
    rows = rows.filter(F.col("home").isNull() | (F.col("home") == F.struct("part", "run")))
    text = F.when(~F.col("missing"), F.col("body"))
    out = [text.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return rows.select(*out)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
