"""Report queries over the finished facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rowwise import safe_ratio
from ..sources.sinks import save_table
from ..sources.staging import new_stage
from .aggregates import build_fact, total
from .joins import Keys, as_list, join_on


def month_on_month(
    fact: DataFrame, keys: Keys, value: str, month: str = "report_month", higher_is_better: bool = False
) -> DataFrame:
    """Previous value, change and trend per key and month. A key has one row per month, so groups stay small."""
    w = Window.partitionBy(*as_list(keys)).orderBy(month)
    better, worse = ("improving", "deteriorating") if higher_is_better else ("deteriorating", "improving")
    out = fact.withColumn(f"previous_{value}", F.lag(value).over(w))
    out = out.withColumn("change", F.col(value) - F.col(f"previous_{value}"))
    return out.withColumn(
        "trend", F.when(F.col("change") > 0, better).when(F.col("change") < 0, worse).when(F.col("change") == 0, "stable")
    )


def rank_within(
    df: DataFrame, group: Keys, value: str, rank: str = "rank", percent: str = "percent_rank", descending: bool = True
) -> DataFrame:
    """Rank (ties share the smallest) and percent rank of ``value`` inside each group.

    A plain window would sort a whole group in one task. Here equal values are counted first; the counts are dealt
    into ranges of group and value by sampled splitters and stored, so that a task orders its share however a
    group's values are spread. Each range's counts per group give the next ranges their offset. Rows with a missing
    value get no rank.
    """
    group = as_list(group)
    spark = df.sparkSession
    direction = F.desc if descending else F.asc
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = counts.repartitionByRange(ranges, *group, direction(value)).withColumn("__range", F.spark_partition_id())
    counts = save_table(counts, new_stage(spark, "ranges"))
    inner = Window.partitionBy("__range", *group).orderBy(direction(value)).rowsBetween(Window.unboundedPreceding, -1)
    # At most as many rows as there are ranges and groups together.
    outer = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("__range", *group)
        .agg(F.sum("__n").alias("__size"))
        .withColumn("__offset", F.coalesce(F.sum("__size").over(outer), F.lit(0)))
        .withColumn("__rows", F.sum("__size").over(Window.partitionBy(*group)))
        .drop("__size")
    )
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(inner), F.lit(0)))
    ranks = join_on(counts, offsets, ["__range", *group], "inner").select(
        *group, value, (F.col("__offset") + F.col("__before") + 1).alias(rank), "__rows"
    )
    share = F.when(F.col("__rows") > 1, (F.col(rank) - 1) / (F.col("__rows") - 1)).otherwise(F.lit(0.0))
    out = join_on(df, ranks, [*group, value])
    return out.withColumn(percent, F.when(F.col(rank).isNotNull(), share)).drop("__rows")


def share_of_total(
    fact: DataFrame, group: Keys, by: Keys, value: str, name: str = "share"
) -> DataFrame:
    """Sum of ``value`` per (group, by) and its share of the group. Both sums come before the join."""
    group, by = as_list(group), as_list(by)
    parts = fact.groupBy(*group, *by).agg(total(value).alias(value))
    wholes = parts.groupBy(*group).agg(F.sum(value).alias("__whole"))
    return join_on(parts, wholes, group).withColumn(name, safe_ratio(value, "__whole")).drop("__whole")


def region_compare(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    right_on: str,
    region: Keys,
    measures: Sequence[str],
    ratio: tuple[str, str, str],
    group: Keys = (),
) -> DataFrame:
    """Measures per region of the dimension, with the ratio taken after the sums.

    The fact is summed per dimension key before it meets the dimension.
    """
    group = as_list(group)
    small = build_fact(fact, [*group, on], measures)
    regions = as_list(region)
    looked_up = join_on(small, dim.select(F.col(right_on).alias(on), *regions), on)
    return build_fact(looked_up, [*group, *regions], measures, ratio)


def latest_period(fact: DataFrame, month: str = "report_month") -> DataFrame:
    """Rows of the newest month.

    The newest month is found first and then filtered by, as a value: from a table stored by month, the first step
    reads partition names and row counts only, and the second one partition. A computed fact should be stored first.
    """
    newest = fact.agg(F.max(month)).first()[0]
    return fact.filter(F.col(month) == F.lit(newest))


def drilldown(fact: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Rows that meet every filter: a value, a list of values, or a (low, high) tuple for a range."""
    for name, wanted in filters.items():
        c = F.col(name)
        if isinstance(wanted, tuple):
            fact = fact.filter(c.between(*wanted))
        elif isinstance(wanted, list):
            fact = fact.filter(c.isin(wanted))
        else:
            fact = fact.filter(c == wanted)
    return fact
