"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact check, components.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z as a-z. A document's set holds its
distinct runs of ``words`` words, as 64-bit hashes; a document of fewer words has the whole sequence as
its one member; one without words has an empty set and is linked with nothing. Two documents are linked
if their sets' Jaccard similarity is ``percent`` / 100 or more.

1. Documents with one set become one class, whose representative is the smallest id (a grouped minimum).
2. Representatives that agree in a band of their signature are candidates. Every band bucket first pairs
   its members with one of them, drawn by a hash, so a bucket of n costs n pairs.
3. Candidates' signatures are compared a batch at a time. A pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold, given the agreements so far, falls below
   ``miss``. Survivors are checked on their full sets, so every link is exact; a survivor whose ends
   other links connect meanwhile needs no check.
4. The links make components. In buckets that still hold more than one, every member outside the largest
   component is compared with all members in other components, block against block: the exact sizes of
   all shared sets of two blocks come from one product of matrices, and only links leave the task. So no
   link between candidates is lost, and a bucket of near copies never makes all its pairs.

With 24 bands of 4, a pair at similarity 0.8 shares no band with probability 3e-6.
Repeated rows are copies. Rows with a null id are in classes, but never give them their name.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from . import words as W
from .components import components
from .memory import tidy
from .shared import broadcast_if_small, same, stored, whole_text

BANDS, ROWS, BATCHES, BATCH = 24, 4, 4, 32
HASHES = BATCHES * BATCH
SEED = 20240607
BLOCK = 256  # sets of a block that is compared with another block
COLUMNS = 1 << 14  # shared members counted in one step


def shingle_sets(column: pa.Array, k: int, hasher: W.WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(members of all sets, row of each), sorted by row and member."""
    words, rows = hasher(column)
    n = np.bincount(rows, minlength=len(column))
    made = np.full(max(len(words) - k + 1, 0), k, W.U64)
    for j in range(k):
        made = W.mix(made * W.U64(0xD6E8FEB86659FD93) + words[j : len(words) - k + 1 + j])
    whole = rows[: len(made)] == rows[k - 1 :] if len(made) else np.empty(0, bool)
    members, of = made[whole], rows[: len(made)][whole]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = np.concatenate(([0], np.cumsum(n)))
        extra = np.array([n[r] for r in short], W.U64)
        for j in range(k - 1):
            has = n[short] > j
            step = W.mix(extra[has] * W.U64(0xD6E8FEB86659FD93) + words[first[short[has]] + j])
            extra[has] = step
        members, of = np.concatenate((members, extra)), np.concatenate((of, short))
    order = np.lexsort((members, of))
    members, of = members[order], of[order]
    fresh = np.ones(len(members), bool)
    fresh[1:] = (members[1:] != members[:-1]) | (of[1:] != of[:-1])
    return members[fresh], of[fresh]


def signature_rows(k: int):
    """A task over (id, text): id, set size, 128-bit digest of the set, signature and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, draw = W.WordHasher(), np.random.default_rng(SEED)
        factors = draw.integers(0, 1 << 63, HASHES, dtype=np.int64).astype(W.U64) * W.U64(2) + W.U64(1)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n = part.num_rows
                members, of = shingle_sets(part.column(1), k, hasher)
                size = np.bincount(of, minlength=n)
                filled = np.flatnonzero(size)
                starts = np.concatenate(([0], np.cumsum(size)))[filled]
                digest = np.zeros((n, 2), W.U64)
                signature = np.zeros((n, HASHES), np.uint32)
                if len(filled):
                    digest[filled, 0] = np.add.reduceat(W.mix(members ^ W.U64(0xA5A5A5A5A5A5A5A5)), starts)
                    digest[filled, 1] = np.bitwise_xor.reduceat(W.mix(members + W.U64(0x1234567)), starts)
                    # A few sets at a time, so that the members stay in the processor's cache.
                    ends = np.append(starts[1:], len(members))
                    lo = 0
                    while lo < len(filled):
                        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 15), side="right")))
                        some, heads = members[starts[lo] : ends[hi - 1]], starts[lo:hi] - starts[lo]
                        for j in range(HASHES):
                            signature[filled[lo:hi], j] = np.minimum.reduceat(some * factors[j], heads) >> W.U64(32)
                        lo = hi
                keys = np.tile(np.arange(1, BANDS + 1, dtype=W.U64), (n, 1))
                for j in range(ROWS):
                    keys = W.mix(keys * W.U64(0x9E3779B97F4A7C15) + signature[:, j : BANDS * ROWS : ROWS])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(size.astype(np.int64)),
                        pa.array(digest[:, 0].view(np.int64)),
                        pa.array(digest[:, 1].view(np.int64)),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.ravel().view(np.int64))
                        ),
                    ],
                    ["id", "size", "set_a", "set_b", "signature", "keys"],
                )

    return run


def set_rows(k: int):
    """A task over (id, text): id and the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                members, of = shingle_sets(part.column(1), k, hasher)
                offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=part.num_rows))))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(members.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "members"])

    return run


def least_agreements(threshold: float, miss: float) -> list[int]:
    """For each batch, the least number of agreements at which a pair goes on. With a flat prior, the
    posterior chance that the similarity reaches t after m of n agreements is P(Bin(n + 1, t) <= m)."""
    found = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return found


def prune_rows(least: list[int]):
    """A task over (a, b, sig_a, sig_b): the pairs that no batch of the signatures rules out, and how many
    hashes agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            alive = np.arange(batch.num_rows)
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in (2, 3)
            )
            agreed = np.zeros(len(alive), np.int64)
            for step, needed in enumerate(least):
                part = slice(step * BATCH, (step + 1) * BATCH)
                agreed = agreed + (left[alive, part] == right[alive, part]).sum(1)
                alive, agreed = alive[agreed >= needed], agreed[agreed >= needed]
            kept = [batch.column(c).take(pa.array(alive)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(agreed.astype(np.int32))], ["a", "b", "agreed"])

    return run


@dataclass
class Search:
    """What the steps of one search share: the classes' signatures, the texts, and how to compare."""

    classes: DataFrame
    texts: DataFrame
    words: int
    percent: int
    miss: float

    def survivors(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that their sizes and signatures do not rule out, stored."""
        mine = self.classes.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("signature").alias("sig_a"))
        other = self.classes.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("signature").alias("sig_b"))
        # The smaller set can hold no more than all of the shared members.
        near = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * self.percent
        sized = pairs.join(mine, "a").join(other, "b").filter(near).select("a", "b", "sig_a", "sig_b")
        least = least_agreements(self.percent / 100, self.miss)
        return stored(sized.mapInArrow(tidy(prune_rows(least)), "a bigint, b bigint, agreed int"), "survivors")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(id, members): the whole sets of the texts with these ids, stored."""
        wanted = broadcast_if_small(stored(ids, "wanted"), 16)
        found = self.texts.join(wanted, "id", "left_semi").mapInArrow(tidy(set_rows(self.words)), "id bigint, members array<bigint>")
        # Rows of one id and one text give the same set.
        return stored(found.distinct(), "sets")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough, stored."""
        pairs = stored(pairs, "checked")
        sets = self.sets(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
        whole = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - shared
        return stored(whole.filter(shared * 100 >= union * self.percent).select("a", "b").distinct(), "links")

    def connected(self, pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """``groups`` (node, component), joined further by the links among ``pairs``. The best pair of each
        node is checked first; of the others, those that are still between two components."""
        todo = self.survivors(pairs)
        best = todo.groupBy("a").agg(F.max(F.struct("agreed", "b")).alias("best")).select("a", "best.b")
        groups = self._joined(self.linked(best), groups)
        first, second = groups.toDF("a", "of_a"), groups.toDF("b", "of_b")
        left = todo.select("a", "b").join(best, ["a", "b"], "left_anti").join(first, "a", "left").join(second, "b", "left")
        left = stored(left.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"), "open")
        return groups if left.isEmpty() else self._joined(self.linked(left), groups)

    def finished(self, placed: DataFrame, groups: DataFrame) -> DataFrame:
        """``groups``, joined by all links of members outside ``main``, the largest component of their bucket,
        with other members of buckets of this component. ``placed`` has key, id, of, main."""
        members = stored(placed.select("main", "id", "of").distinct(), "members")
        sets = self.sets(members.select("id").distinct())
        rows = members.join(sets, "id")
        # Blocks by hash: as many as the sets of a component, outside and in all, need.
        sizes = members.groupBy("main").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("of") != F.col("main")).alias("outside"))
        sizes = sizes.select("main", *[F.ceil(F.col(n) / BLOCK).cast("int").alias(f"{n}_blocks") for n in ("n", "outside")])
        rows = stored(rows.join(sizes, "main"), "blocks")

        def spread(of_side: DataFrame, side: int, own: str, other: str, names: list[str]) -> DataFrame:
            block = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(names[0])
            every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1])
            made = of_side.select("main", block, every, "id", "of", "members", F.lit(side).alias("side"))
            return made.select("main", "p", "q", "side", "id", "of", "members")

        rows = rows.filter("outside_blocks > 0")
        x = spread(rows.filter("of <> main"), 0, "outside_blocks", "n_blocks", ["p", "q"])
        y = spread(rows, 1, "n_blocks", "outside_blocks", ["q", "p"])
        links = x.union(y).groupBy("main", "p", "q").applyInArrow(compare_blocks(self.percent), "a bigint, b bigint")
        ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        return self._joined(stored(ordered, "links"), groups)

    def _joined(self, links: DataFrame, groups: DataFrame) -> DataFrame:
        return stored(components(links.union(groups.toDF("a", "b"))), "groups")


def _paired(placed: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket (key, id) with one of it, drawn by a hash."""
    drawn = placed.groupBy("key").agg(F.min_by("id", F.xxhash64("id", "key")).alias("drawn"))
    both = placed.join(drawn, "key").filter("id <> drawn")
    return both.select(F.greatest("id", "drawn").alias("a"), F.least("id", "drawn").alias("b")).distinct()


def shared_sizes(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set of ``left`` shares with each of ``right``."""
    x, y = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(x, y)
    total = np.zeros((len(left), len(right)), np.float32)

    def places(values: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(both, values)
        hit = both[np.minimum(at, max(len(both) - 1, 0))] == values if len(both) else np.zeros(len(values), bool)
        return row[hit], at[hit]

    (row_x, at_x), (row_y, at_y) = places(x, left), places(y, right)
    for lo in range(0, len(both), COLUMNS):
        tables = []
        for row, at, n in ((row_x, at_x, len(left)), (row_y, at_y, len(right))):
            table = np.zeros((n, min(COLUMNS, len(both) - lo)), np.float32)
            here = (at >= lo) & (at < lo + COLUMNS)
            table[row[here], at[here] - lo] = 1
            tables.append(table)
        total += tables[0] @ tables[1].T
    return total


def compare_blocks(percent: int):
    """Two blocks, told apart by ``side``, of (id, of, members): the links (a, b) between components."""

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        ids, of = table["id"].to_numpy(), table["of"].to_numpy()
        sets = [np.asarray(m.values) for m in table["members"].combine_chunks()]
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        i = j = np.empty(0, np.int64)
        if len(x) and len(y):
            shared = shared_sizes([sets[k] for k in x], [sets[k] for k in y])
            size = np.array([len(m) for m in sets])
            union = size[x][:, None] + size[y][None, :] - shared
            i, j = np.nonzero((shared * 100 >= union * percent) & (of[x][:, None] != of[y][None, :]))
        return pa.table({"a": pa.array(ids[x[i]], pa.int64()), "b": pa.array(ids[y[j]], pa.int64())})

    return run


def _mixed(placed: DataFrame) -> DataFrame:
    """The buckets with members in more than one component, with ``main``, the largest of these."""
    parts = placed.groupBy("key", "of").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", F.col("of").alias("main"))).alias("largest")
    buckets = parts.groupBy("key").agg(F.sum("n").alias("n"), largest).select("key", "n", "largest.main", F.col("largest.n").alias("inside"))
    return buckets.filter("inside < n")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id it is linked with, over
    any number of links), kept (whether that is its own id)."""
    texts = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    schema = "id bigint, size bigint, set_a bigint, set_b bigint, signature binary, keys array<bigint>"
    signed = stored(texts.mapInArrow(tidy(signature_rows(words)), schema), "signatures")
    classes = signed.filter("size > 0").groupBy("set_a", "set_b", "size").agg(
        F.min("id").alias("id"), F.first("signature").alias("signature"), F.first("keys").alias("keys")
    )
    classes = stored(classes, "classes")
    named = classes.filter("id IS NOT NULL")

    search = Search(named.select("id", "size", "signature"), texts, words, percent, miss)
    keyed = named.select("id", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    placed = stored(keyed.join(buckets, "key").select("key", "id", F.col("id").alias("of")), "buckets")
    groups = search.connected(_paired(placed), spark.createDataFrame([], "node bigint, component bigint"))
    of = placed.drop("of").join(groups.toDF("id", "component"), "id", "left")
    placed = stored(of.select("key", "id", F.coalesce("component", "id").alias("of")), "placed")
    # In a bucket of two, both were compared.
    open_ = stored(placed.join(_mixed(placed).filter("n > 2").select("key", "main"), "key"), "mixed")
    if not open_.isEmpty():
        groups = search.finished(open_, groups)

    final = classes.select("set_a", "set_b", "size", "id").join(
        groups.select(F.col("node").alias("id"), "component"), "id", "left"
    )
    final = final.select("set_a", "set_b", "size", F.coalesce("component", "id").alias("component"))
    rows = signed.select("id", "size", "set_a", "set_b").join(final, ["set_a", "set_b", "size"], "left")
    component = F.coalesce("component", "id")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, null last, and of one id the one
    with the smallest text hash. Rows of one id and one text are one document; other texts of that id are others."""
    texts = docs.select(
        quoted(id_col).alias("doc"), F.xxhash64(whole_text(text_col)).alias("mixed"), quoted(text_col).cast("string").alias("text")
    )
    # Numbers that rise with the order of the documents.
    ordered = texts.select(F.col("doc").alias("__doc"), F.col("mixed").alias("__mixed")).distinct()
    ordered = ordered.orderBy(F.col("__doc").asc_nulls_last(), "__mixed")
    numbers = stored(ordered.withColumn("node", F.monotonically_increasing_id()), "numbers")
    match = same(F.col("doc"), F.col("__doc")) & (F.col("mixed") == F.col("__mixed"))
    found = near_groups(texts.join(broadcast_if_small(numbers, 64), match).select("node", "text"), "node", "text", **options)
    gone = found.filter("NOT kept").select("node").distinct()
    gone = stored(numbers.join(gone, "node").select("__doc", "__mixed"), "near-copies")
    match = same(quoted(id_col), F.col("__doc")) & (F.xxhash64(whole_text(text_col)) == F.col("__mixed"))
    return docs.join(broadcast_if_small(gone, 64), match, "left_anti")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
