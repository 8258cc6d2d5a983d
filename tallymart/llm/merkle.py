"""Merkle manifest of a dataset, with a witness for every row, built by incremental appends.

A row's leaf is a digest of its fields. The leaves of a group, in the order of their ids, make one tree: every
two neighbours become their digest, level by level, an odd last one its own digest, until one node remains. The
groups' roots, in the order of their names, make the tree of the whole in the same way.

A task appends the nodes of an aligned block of ``BLOCK`` places in order. Nodes are open subtrees; two of one
height close into one, which gives each member the other side's digest as the next part of its witness. What is
still open at the end of a tree is closed upwards in the same way. The roots of the blocks are stored, and are
appended themselves by the next round, whose witnesses extend those of all their members, until a single block
is left. So no task holds more than a block, whatever the size of a group, and every round is ``BLOCK`` times
smaller than the one before. Places come from one range partitioning by group and id, in which a group that
holds many rows lies in many partitions; only rows per partition and group are summed beside it.

Digests are of hexadecimal text, inputs concatenated. Null ids and groups come first; rows with one id are
ordered by their leaf, equal rows are leaves of their own. An empty table gives no rows. Any number of columns of
any name may be in ``docs``.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .memory import tidy
from .shared import broadcast_if_small, partitions, same, schema_of, stored

BLOCK = 1 << 10  # places of a block, a power of two


def field_digest(fields: Sequence[Column]) -> Column:
    """The digest of fields, each as ``-`` if null, else its length in bytes, ``:`` and its text."""
    parts = [c.cast("string") for c in fields]
    told = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Subtrees:
    """The open subtrees of one block: each with its height, digest and the places it holds. ``witness`` has the
    siblings of each place so far: ``L`` or ``R`` for the side and the digest, or ``-`` for a node without one."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, list[int]]] = []
        self.witness: list[list[str]] = []

    def append(self, node: str) -> None:
        self.open.append((0, node, [len(self.witness)]))
        self.witness.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._close()

    def _close(self) -> None:
        """The last two, which are of one height, become one."""
        height, right, right_places = self.open.pop()
        _, left, left_places = self.open.pop()
        for places, sibling in ((left_places, "R" + right), (right_places, "L" + left)):
            for place in places:
                self.witness[place].append(sibling)
        self.open.append((height + 1, digest(left + right), left_places + right_places))

    def finish(self, height: int | None) -> str:
        """The root, at ``height``, or where a single node remains."""
        while len(self.open) > 1 or (height is not None and self.open[-1][0] < height):
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._close()
                continue
            at, node, places = self.open.pop()
            for place in places:
                self.witness[place].append("-")
            self.open.append((at + 1, digest(node), places))
        return self.open[-1][1]


def append_rows(block: int):
    """A task over rows (tree, place, blocks, node), sorted by tree and place: the same rows with the witness inside
    their block and the block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, subtrees, rows = None, Subtrees(), []

        def closed() -> pa.RecordBatch:
            # A lone block is the whole tree and ends at its root; else all blocks have one height.
            root = subtrees.finish(block.bit_length() - 1 if key[2] > 1 else None)
            trees, places, nodes = zip(*rows)
            columns = [pa.array(trees, pa.int64()), pa.array(places, pa.int64()), pa.array([key[1]] * len(rows), pa.int64())]
            columns += [pa.array(nodes), pa.array(subtrees.witness, pa.list_(pa.string())), pa.array([root] * len(rows))]
            return pa.RecordBatch.from_arrays(columns, ["tree", "place", "block", "node", "witness", "root"])

        for batch in batches:
            for tree, place, blocks, node in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (tree, place // block, blocks):
                    if rows:
                        yield closed()
                    key, subtrees, rows = (tree, place // block, blocks), Subtrees(), []
                subtrees.append(node)
                rows.append((tree, place, node))
        if rows:
            yield closed()

    return run


def _round(nodes: DataFrame, sizes: DataFrame, size: int) -> DataFrame:
    """(tree, place, block, node, witness, root), stored: one round of appends to all trees. ``nodes`` has tree, place
    and node, ``sizes`` tree and n, the number of its nodes."""
    blocks = sizes.select("tree", F.ceil(F.col("n") / size).cast("bigint").alias("blocks"))
    rows = nodes.join(broadcast_if_small(blocks, 16), "tree").select("tree", "place", "blocks", "node")
    block = F.floor(F.col("place") / size)
    dealt = rows.repartition(partitions(nodes.sparkSession), "tree", block).sortWithinPartitions("tree", "place")
    schema = "tree bigint, place bigint, block bigint, node string, witness array<string>, root string"
    return stored(dealt.mapInArrow(tidy(append_rows(size)), schema), "round")


def witnesses(nodes: DataFrame, sizes: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """For nodes (tree, place, node), their places counted from 0: (tree, place, node, witness) with whole witnesses,
    and (tree, root)."""
    rounds = [_round(nodes, sizes, block)]
    while True:
        roots = rounds[-1].select("tree", F.col("block").alias("place"), F.col("root").alias("node")).distinct()
        sizes = stored(sizes.select("tree", F.ceil(F.col("n") / block).cast("bigint").alias("n")), "sizes")
        if sizes.filter("n > 1").isEmpty():
            break
        # Trees that are done stay out; their only block's root is their root.
        more = stored(roots.join(sizes.filter("n > 1").select("tree"), "tree"), "roots")
        rounds.append(_round(more, sizes.filter("n > 1"), block))
    found = rounds.pop()
    while rounds:
        up = found.select("tree", F.col("place").alias("block"), F.col("witness").alias("further"), F.col("root").alias("top"))
        down = rounds.pop().join(broadcast_if_small(stored(up, "further"), 1024), ["tree", "block"], "left")
        found = down.select(
            "tree", "place", "block", "node",
            F.concat("witness", F.coalesce("further", F.array().cast("array<string>"))).alias("witness"),
            F.coalesce("top", "root").alias("root"),
        )
    return found.select("tree", "place", "node", "witness", "root"), found.select("tree", "root").distinct()


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stored ``rows`` with tree, the place of their group among all groups, and place, their own inside it, and
    (tree, group, n). Both stored."""
    spark = rows.sparkSession
    n = partitions(spark)
    first = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    spread = rows.repartitionByRange(n, *first).sortWithinPartitions(*first)
    # Numbers rise with the order, and are consecutive inside a partition.
    numbered = stored(spread.withColumn("number", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("number", 33).alias("part")
    spans = numbered.groupBy(part, group).agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("low"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(spans.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))), "spans")
    groups = stored(spans.groupBy(group).agg(F.sum("n").alias("n")), "groups")
    ordered = groups.repartitionByRange(n, F.col(group).asc_nulls_first()).sortWithinPartitions(F.col(group).asc_nulls_first())
    groups = stored(ordered.withColumn("number", F.monotonically_increasing_id()), "group-numbers")
    counted = groups.groupBy(F.shiftright("number", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition.
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    groups = groups.withColumn("part", F.shiftright("number", 33)).join(F.broadcast(counted.select("part", "before")), "part")
    inside = F.col("number") - F.shiftleft("part", 33)
    trees = stored(groups.select((F.col("before") + inside).alias("tree"), group, "n"), "trees")
    spans = spans.join(trees.select(F.col(group).alias("__group"), "tree"), same(F.col(group), F.col("__group")))
    spans = stored(spans.select("part", F.col(group).alias("__group"), "tree", (F.col("offset") - F.col("low")).alias("shift")), "shifts")
    numbered = numbered.withColumn("part", F.shiftright("number", 33))
    match = (numbered["part"] == spans["part"]) & same(numbered[group], spans["__group"])
    out = numbered.join(broadcast_if_small(spans), match)
    return stored(out.select("tree", (F.col("number") + F.col("shift")).alias("place"), *rows.columns), "placed"), trees


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""

    def up(node: Column, step: Column) -> Column:
        side, sibling = F.substring(step, 1, 1), F.substring(step, 2, 64)
        both = F.when(side == "L", F.concat(sibling, node)).when(side == "R", F.concat(node, sibling)).otherwise(node)
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(witness, leaf, up)


def siblings(witness: Column) -> Column:
    """The digest of a witness's siblings, from the leaf up."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: F.substring(step, 2, 64)), "").cast("binary"), 256)


def manifest(
    docs: DataFrame, fields: Sequence[str], group_col: str, id_col: str, extra: dict[str, Column] | None = None, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, witness, and the columns of ``extra``. The witness goes from
    the leaf by its group's root to the root of all."""
    extra = extra or {}
    rows = docs.select(
        quoted(group_col).cast("string").alias("group"), quoted(id_col).alias("id"),
        field_digest([quoted(c) for c in fields]).alias("leaf"), *[c.alias(f"extra_{n}") for n, c in extra.items()],
    )
    leaves, trees = placed(stored(rows, "leaves"), "group", ["id", "leaf"])
    found, roots = witnesses(leaves.select("tree", "place", F.col("leaf").alias("node")), trees.select("tree", "n"), block)
    # The groups' roots are leaves of one more tree.
    tops = stored(roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.col("root").alias("node")), "subroots")
    n = tops.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    above, _ = witnesses(tops, stored(n, "n-subroots"), block)
    above = above.select(F.col("place").alias("tree"), F.col("node").alias("subroot"), F.col("witness").alias("above"), F.col("root").alias("top"))
    found = found.select("tree", "place", "witness").join(leaves, ["tree", "place"])
    found = found.join(broadcast_if_small(stored(above, "above")), "tree")
    return found.select(
        F.col("id").alias(id_col), "leaf", "subroot", F.col("top").alias("root"), F.concat("witness", "above").alias("witness"),
        *[F.col(f"extra_{n}").alias(n) for n in extra],
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
