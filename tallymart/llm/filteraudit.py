"""Filter interaction audit: what every order of the filters removes, without running any of them again.

Filters that follow each other remove a document at the first one it fails. So all that matters of a document
is its mask, the set of filters it fails. Documents are counted by part and mask; then every order is told from
these counts. The orders of n letters are ranked lexicographically (their Lehmer code read as a number), so
the orders with one beginning are one interval of ranks. For each mask the beginnings at whose last filter it
is removed, or fails though it is removed already, are such intervals: their counts are added at the first rank
and taken off behind the last one, in one array of differences for every part and step. Prefix sums over the
ranks give all orders at once.

Null texts count as empty. A row with a null id is no copy of another row and none is a copy of it; rows that
share id and text are no copies of each other, but each counts. A document is good or toxic if any of its rows
in ``labels`` says so. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import broadcast_if_small, stored, whole_text

MOST_FILTERS = 6  # the intervals of a mask grow with the factorial of this

Conditions = Mapping[str, Column]


def lehmer_rank(order: str, letters: str) -> int:
    """Place of an order, or of the first order that begins so, among all orders of the sorted letters."""
    rest, rank = sorted(letters), 0
    for letter in order:
        rank += rest.index(letter) * factorial(len(rest) - 1)
        rest.remove(letter)
    return rank


def intervals(letters: str) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, first rank, rank behind the last, removed): for each mask and beginning whose last filter it
    fails, whether that filter removes it (1) or an earlier one has (0). Bit i of a mask is the letter i."""
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    found = []
    for step in range(1, len(letters) + 1):
        for beginning in permutations(letters, step):
            low = lehmer_rank("".join(beginning), letters)
            high = low + factorial(len(letters) - step)
            before = sum(bit[x] for x in beginning[:-1])
            for mask in range(1, 1 << len(letters)):
                if mask & bit[beginning[-1]]:
                    found.append((mask, step, low, high, int(not mask & before)))
    return found


def orders(letters: str) -> list[tuple[int, str]]:
    """(rank, order) of all orders."""
    return [(rank, "".join(order)) for rank, order in enumerate(permutations(sorted(letters)))]


def mask_of(conditions: Conditions, letters: str) -> Column:
    """The filters a row fails, as bits; a condition that is null is not met."""
    bits = [F.when(conditions[x], 1 << i).otherwise(0) for i, x in enumerate(letters) if x in conditions]
    return sum(bits[1:], bits[0]) if bits else F.lit(0)


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """(part, mask, good, toxic, n): the counts of ``rows`` (id, text_sha, part, mask, good, toxic), where rows whose
    text a row with a smaller id has get ``bit`` in their mask.

    Copies are counted by text, part, mask and labels before they meet; a text with any number of copies is a few
    rows then. Of each such count the rows that hold the smallest id are kept apart.
    """
    kind = ["text_sha", "part", "mask", "good", "toxic"]
    ids = rows.filter("id IS NOT NULL").groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct("id", "n")).alias("first")
    counted = stored(ids.groupBy(*kind).agg(F.sum("n").alias("n"), first), "copies")
    least = stored(counted.groupBy("text_sha").agg(F.min("first.id").alias("least")), "least")
    own = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    counted = counted.join(least, "text_sha").withColumn("own", own)
    counts = ["part", "mask", "good", "toxic"]
    firsts = counted.select(*counts, F.col("own").alias("n"))
    copies = counted.select("part", F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), "good", "toxic", (F.col("n") - F.col("own")).alias("n"))
    unnamed = rows.filter("id IS NULL").groupBy(*counts).agg(F.count(F.lit(1)).alias("n"))
    return firsts.union(copies).union(unnamed.select(*counts, "n")).filter("n > 0")


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order and step: filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. ``counts`` has part, mask, good, toxic and n, in any number of rows."""
    if len(letters) > MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"the filters must be at most {MOST_FILTERS} different letters")
    spark = counts.sparkSession
    letters = "".join(sorted(letters))
    n, good, toxic = F.col("n"), F.when(F.col("good"), F.col("n")), F.when(F.col("toxic"), F.col("n"))
    masks = counts.groupBy("part", "mask").agg(F.sum(n).alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic"))
    masks = stored(masks.fillna(0), "masks")
    parts = masks.groupBy("part").agg(F.sum("n").alias("total"))

    # Both tables depend on the number of filters alone.
    steps = F.broadcast(spark.createDataFrame(intervals(letters), "mask int, step int, low int, high int, removes int"))
    ranks = F.broadcast(spark.createDataFrame(orders(letters), "rank int, filter_order string"))
    met = masks.join(steps, "mask")
    what = {"removed": ("n", 1), "redundant": ("n", 0), "good_lost": ("good", 1), "toxic_lost": ("toxic", 1)}
    deltas = {name: F.when(F.col("removes") == r, F.col(c)).otherwise(0) for name, (c, r) in what.items()}
    ends = [met.select("part", "step", F.col(at).alias("rank"), *[(sign * d).alias(c) for c, d in deltas.items()])
            for at, sign in (("low", 1), ("high", -1))]
    # Steps and ranks at which nothing changes have rows too.
    grid = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(factorial(len(letters)) - 1))).alias("rank"))
    grid = grid.select("part", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"), "rank", *[F.lit(0).cast("bigint").alias(c) for c in what])
    events = ends[0].union(ends[1]).union(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in what])
    behind = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    told = events.withColumns({c: F.sum(c).over(behind) for c in what}).join(ranks, "rank")
    told = told.withColumn("letter", F.expr("substring(filter_order, step, 1)"))

    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    told = told.withColumn("gone", F.sum("removed").over(so_far))
    told = stored(told, "audit")
    shapley = told.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    single = F.coalesce(*[F.when(F.col("mask") == 1 << i, F.lit(x)) for i, x in enumerate(letters)])
    alone = masks.filter(F.bit_count("mask") == 1).select("part", single.alias("letter"), F.col("n").alias("unique_fails"))
    out = told.join(parts, "part").join(shapley, ["part", "letter"]).join(alone, ["part", "letter"], "left")
    long = {"kept": F.col("total") - F.col("gone"), "unique_fails": F.coalesce("unique_fails", F.lit(0))}
    return out.withColumns({c: e.cast("bigint") for c, e in long.items()}).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_documents(
    docs: DataFrame,
    labels: DataFrame,
    conditions: Conditions,
    copies: str,
    part_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The audit of ``docs``: a row fails the filter of a letter if its condition, over ``text`` (null as empty) and the
    columns of ``docs``, is met, and the filter ``copies`` if a row with a smaller id has its text. ``labels`` has
    ``id_col``, quality and toxic."""
    letters = "".join(sorted([*conditions, copies]))
    text = whole_text(text_col)
    read = docs.withColumn(text_col, text)
    rows = read.select(
        quoted(id_col).alias("id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_sha"),
        F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"),
        mask_of(conditions, letters).alias("mask"),
    )
    rows = stored(rows, "failures")
    said = labels.groupBy(quoted(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    rows = rows.join(broadcast_if_small(stored(said, "labels"), 24), "id", "left").fillna(False, ["good", "toxic"])
    return audit(with_copies(rows, 1 << letters.index(copies)), letters)


def text_conditions(text_col: str = "text") -> dict[str, Column]:
    """The filters A to D on the whole text: too few words, too few different words, too many capitals, signs."""
    text = quoted(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": n < 50,
        "B": different * 100 < n * 65,
        "C": capitals * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }
