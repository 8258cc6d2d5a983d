"""N-gram Jaccard join with set relations: blocks of an inverted index are skipped by size and position, and a
set's answers are derived from those of a set that is very like it.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z as a-z. A document's set holds its distinct
runs of ``words`` words, as 64-bit hashes; a document of fewer words has the whole sequence as its one member;
null texts and texts without words have an empty set and are linked with nothing. Two documents are linked if
their sets' Jaccard similarity is ``percent`` / 100 or more.

1. Documents with one set become one node. The members of every set are put in one order, rare ones first: by a
   count over all documents, kept in ``SKETCH`` counters, and by their hash. Any order gives right results; this
   one keeps members that many documents share out of the index.
2. The index holds the first members of each set, so many that two linked sets have at least one of them in
   common. Members that only one set has are dropped.
3. Each list of the index is cut into blocks of like size. Every set is compared with the first set of its
   block, by a hash order that is the same in all lists, if they meet in many. Sets that are linked with such a leader, which has no
   leader itself, form its group and keep what they have more and less than the leader.
   In long lists sets are compared with some that are drawn from the list's largest part, for as long as this links
   many; it joins large groups whose sets are linked, but not with one leader.
4. Now a list is a short list of groups, each a block with its least size and its largest rest behind a shared
   member's position. Two blocks are skipped if these rule out every link between them, or if their groups are
   already connected. The leaders of the others are compared, first by a few leading bits of their members,
   which give an upper bound of what they share, then, if it allows a link, by their whole sets.
5. What two groups' members share follows from what their leaders share: it changes by the members that each
   has more and less than its leader. Only pairs that these differences allow are looked at, no whole sets are
   read again, and all links are exact.

So a group of near copies costs one row a list, never its pairs. Rows of one id and different texts are nodes of
their own, as are rows with a null id, which give no component its name. Repeated rows are copies. An empty table
gives no rows. Ids may be of any type that can be ordered.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._columns import quoted
from . import words as W
from .components import components
from .memory import tidy
from .minhash import shingle_sets
from .shared import broadcast_if_small, same, schema_of, stored, whole_text

SKETCH = 1 << 16  # counters of the member order, whatever the size of the data
STEP = 300  # texts whose sets are made at once, at most 512
SHORT = 6  # bits of a member in a short form, beyond those that number the members
LONG = 256  # sets of a list from which on draws join its parts before they are compared
DRAWS = 4  # draws for a set in the first turn; each turn has twice as many
SALTS = 64  # parts of the list of a member that very many sets may hold


def digest_rows(k: int):
    """A task over (id, mixed, text): for each row the size and digest of its set, then how many sets of the task
    hold a member of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total, kinds = W.WordHasher(), np.zeros(SKETCH, np.int64), None
        names = ["id", "mixed", "size", "set_a", "set_b", "bucket", "n"]
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in (0, 1)]
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                n = part.num_rows
                members, of = shingle_sets(part.column(2), k, hasher)
                total += np.bincount((members & W.U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                size = np.bincount(of, minlength=n)
                filled = np.flatnonzero(size)
                starts = np.concatenate(([0], np.cumsum(size)))[filled]
                digest = np.zeros((n, 2), W.U64)
                if len(filled):
                    digest[filled, 0] = np.add.reduceat(W.mix(members ^ W.U64(0x5BF03635)), starts)
                    digest[filled, 1] = np.bitwise_xor.reduceat(W.mix(members + W.U64(0x27D4EB2F)), starts)
                told = [pa.array(size.astype(np.int64)), *[pa.array(digest[:, j].view(np.int64)) for j in (0, 1)]]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *told, *[pa.nulls(n, pa.int64())] * 2], names)
        seen = np.flatnonzero(total)
        if len(seen):
            blank = [pa.nulls(len(seen), kind) for kind in (*kinds, *[pa.int64()] * 3)]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(seen), pa.array(total[seen])], names)

    return run


def bucket_order(counts: DataFrame) -> tuple[np.ndarray, int]:
    """The place of each bucket, rare ones first, and the first place of those that hold far more than the others.
    ``counts`` has bucket and n. The number of buckets is fixed, so they may pass through the driver."""
    summed = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counters = np.zeros(SKETCH, np.int64)
    counters[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    places = np.empty(SKETCH, np.int64)
    places[np.argsort(counters, kind="stable")] = np.arange(SKETCH)
    return places.astype(W.U64), int((counters <= 2 * counters.mean() + 1000).sum())


def index_rows(k: int, percent: int, places: np.ndarray, common: int):
    """A task over (id, mixed, text): id, mixed, the first members of the set in order, and how many of them, at the
    end, are in buckets from place ``common`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                n = part.num_rows
                members, of = shingle_sets(part.column(2), k, hasher)
                size = np.bincount(of, minlength=n)
                place = places[(members & W.U64(SKETCH - 1)).astype(np.int64)]
                # One number that sorts by row, place of the bucket, and member.
                order = np.argsort(of.astype(W.U64) << W.U64(55) | place << W.U64(39) | members >> W.U64(25))
                # Linked sets share so many members that they share one of these.
                first = np.where(size > 0, size - (size * percent + 99) // 100 + 1, 0)
                inside = np.arange(len(of)) - np.concatenate(([0], np.cumsum(size)))[:-1][of] < first[of]
                kept, of = members[order][inside], of[inside]
                often = np.bincount(of, weights=place[order][inside] >= common, minlength=n).astype(np.int32)
                offsets = pa.array(np.concatenate(([0], np.cumsum(first))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(kept.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], lists, pa.array(often)], ["id", "mixed", "prefix", "often"])

    return run


def set_rows(k: int):
    """A task over (node, text): node and the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                members, of = shingle_sets(part.column(1), k, hasher)
                offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=part.num_rows))))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(members.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["node", "members"])

    return run


def _short_bits(size: np.ndarray) -> np.ndarray:
    """Leading bits of a member in the short form of a set of this size."""
    return np.frexp(size.astype(np.float64))[1] + SHORT


def short_rows(k: int):
    """A task over (node, text): node, size of the set, and its short form. That is the distinct leading bits of its
    members in rising order, as gaps: bytes 255 that add 255 each, then one that adds itself and one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                members, of = shingle_sets(part.column(1), k, hasher)
                size = np.bincount(of, minlength=part.num_rows)
                lead = (members >> (64 - _short_bits(size)[of]).astype(W.U64)).astype(np.int64)
                first = np.append(True, of[1:] != of[:-1])[: len(of)]
                gap = np.where(first, lead, np.diff(lead, prepend=0) - 1)
                gap, row = gap[gap >= 0], of[gap >= 0]
                ends = np.cumsum(gap // 255 + 1)
                code = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
                code[ends - 1] = gap % 255
                length = np.bincount(row, weights=gap // 255 + 1, minlength=part.num_rows).astype(np.int64)
                raw, cuts = code.tobytes(), np.concatenate(([0], np.cumsum(length)))
                short = pa.array([raw[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size.astype(np.int64)), short], ["node", "size", "short"])

    return run


def _leads(short: pa.Array, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row << 54 | leading bits) of the members in these short forms, each once and in rising order, without the
    last ``drop`` bits of each row; and how many a row has."""
    texts = short.to_pylist()
    code = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.flatnonzero(code < 255)
    cuts = np.cumsum([0, *map(len, texts)])
    row = np.searchsorted(cuts, ends, side="right") - 1
    # Every member adds its bytes and one.
    total = np.cumsum(code, dtype=np.int64)[ends] + np.arange(1, len(ends) + 1)
    before = np.searchsorted(ends, cuts[:-1])
    base = np.concatenate(([0], total))[before]
    key = (row << 54) | (total - base[row] - 1 >> drop[row])
    key = key[np.append(True, key[1:] != key[:-1])[: len(key)]]
    return key, np.bincount(key >> 54, minlength=len(short))


def possible_rows(percent: int):
    """A task over (a, b, size_a, size_b, short_a, short_b, reach, least): the pairs whose short forms agree in so
    many members that they, or members of their groups, may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                size_a, size_b, reach, least = (part.column(c).to_numpy() for c in (2, 3, 6, 7))
                bits_a, bits_b = _short_bits(size_a), _short_bits(size_b)
                bits = np.minimum(bits_a, bits_b)
                (key_a, n_a), (key_b, n_b) = _leads(part.column(4), bits_a - bits), _leads(part.column(5), bits_b - bits)
                # Two rising runs, which this kind of sort merges.
                both = np.sort(np.concatenate((key_a, key_b)), kind="stable")
                agree = np.bincount(both[1:][both[1:] == both[:-1]] >> 54, minlength=part.num_rows)
                # Members of one set with the same leading bits may all be shared.
                most = agree + np.minimum(size_a - n_a, size_b - n_b)
                kept = pa.array((most + reach) * (100 + percent) >= least * percent)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(kept), part.column(1).filter(kept)], ["a", "b"])

    return run


def _enough(shared: Column, sizes: Column, percent: int) -> Column:
    """Whether so many shared members link two sets of these sizes, given their sum."""
    return shared * (100 + percent) >= sizes * percent


def _common(one: str, two: str) -> Column:
    return F.size(F.array_intersect(one, two))


@dataclass
class Sets:
    """The nodes (node, size, id, mixed) of one join, and the texts (id, mixed, text) their sets come from."""

    nodes: DataFrame
    texts: DataFrame
    words: int
    percent: int

    def _made(self, wanted: DataFrame, task, schema: str, label: str) -> DataFrame:
        """What ``task`` makes of the (node, text) of these nodes, stored; one row for each node."""
        places = self.nodes.join(broadcast_if_small(stored(wanted.distinct(), "wanted"), 16), "node", "left_semi")
        places = stored(places.select("node", F.col("id").alias("__id"), F.col("mixed").alias("__mixed")), "places")
        found = self.texts.join(broadcast_if_small(places, 48), same(F.col("id"), F.col("__id")) & (F.col("mixed") == F.col("__mixed")))
        made = stored(found.select("node", "text").mapInArrow(tidy(task), schema), label)
        n = made.agg(F.count("node"), F.count_distinct("node")).first()
        # Rows of one id and one text hold the same set.
        return made if n[0] == n[1] else made.dropDuplicates(["node"])

    def whole(self, wanted: DataFrame) -> DataFrame:
        """(node, members): the whole sets of these nodes, stored."""
        return self._made(wanted, set_rows(self.words), "node bigint, members array<bigint>", "sets")

    def possible(self, pairs: DataFrame, reach: DataFrame) -> DataFrame:
        """The pairs (a, b) of leaders that short forms of their sets do not rule out: neither they nor, by the
        ``reach`` (node, reach, least) of their groups, the members of these can be linked."""
        pairs = stored(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        short = self._made(wanted, short_rows(self.words), "node bigint, size bigint, short binary", "short")
        short = short.join(reach, "node", "left")
        short = short.withColumns({"reach": F.coalesce("reach", F.lit(0)), "least": F.least("least", "size")})
        names = ("size", "short", "reach", "least")
        for side in ("a", "b"):
            pairs = pairs.join(short.select(F.col("node").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names]), side)
        total = [(F.col(f"{n}_a") + F.col(f"{n}_b")).cast("bigint").alias(n) for n in ("reach", "least")]
        pairs = pairs.select("a", "b", "size_a", "size_b", "short_a", "short_b", *total)
        return pairs.mapInArrow(tidy(possible_rows(self.percent)), "a bigint, b bigint")

    def shared(self, pairs: DataFrame, differences: bool = False) -> DataFrame:
        """Pairs (a, b) with both sizes and the number of shared members; of linked pairs, if asked for, what
        ``b`` has ``more`` and ``less`` than ``a``. Stored."""
        pairs = stored(pairs, "pairs")
        sets = self.whole(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        out = both.select(
            "a", "b", F.size("set_a").cast("bigint").alias("size_a"), F.size("set_b").cast("bigint").alias("size_b"),
            F.size(F.array_intersect("set_a", "set_b")).cast("bigint").alias("shared"), "set_a", "set_b",
        )
        linked = _enough(F.col("shared"), F.col("size_a") + F.col("size_b"), self.percent)
        changes = [
            F.when(linked, F.array_except("set_b", "set_a")).alias("more"),
            F.when(linked, F.array_except("set_a", "set_b")).alias("less"),
        ]
        return stored(out.select("a", "b", "size_a", "size_b", "shared", linked.alias("linked"), *(changes if differences else [])), "shared")


def _index(prefixes: DataFrame) -> DataFrame:
    """(member, node, size, rest): the lists that hold more than one set, stored. ``rest`` is how many members
    two sets can share if this is the first that they do. ``prefixes`` has node, size, prefix and often.

    Rows meet by member once. Members that may be in very many sets are dealt out over ``SALTS`` parts, whose rows
    are all kept; of the others, those that are alone go."""
    rows = prefixes.select("node", "size", "often", F.size("prefix").alias("n"), F.posexplode("prefix").alias("pos", "member"))
    often = F.col("pos") >= F.col("n") - F.col("often")
    salt = F.when(often, F.pmod(F.xxhash64("node"), F.lit(SALTS)) + 1).otherwise(0).cast("int").alias("salt")
    # What changes from row to row stands together: compressed rows are a fifth shorter.
    rest = (F.col("size") - F.col("pos")).cast("int").alias("rest")
    rows = rows.select(salt, "node", F.col("size").cast("int").alias("size"), "member", rest)
    list_ = Window.partitionBy("member", "salt").orderBy("node")
    rows = rows.withColumns({"before": F.lag("node").over(list_), "after": F.lead("node").over(list_)})
    kept = rows.filter("salt > 0 OR before IS NOT NULL OR after IS NOT NULL")
    return stored(kept.select("member", "node", "size", "rest"), "index")


def _size_class(size: Column, percent: int) -> Column:
    """Sets of linked documents are of one class or of two that follow each other."""
    # A little wider than the similarity asks for, so that rounding can move no set two classes away.
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100.001 / percent))).cast("int")


def _leaders(index: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): each set and the first set of its block of a list, by a hash order, if they meet in at least
    half of the lists that linked sets of their size can have in common."""
    rows = index.withColumn("class", _size_class(F.col("size"), percent))
    first = rows.groupBy("member", "class").agg(F.min_by(F.struct("node", "size"), F.xxhash64("node")).alias("head"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(first.filter("n > 1").drop("n"), ["member", "class"]).filter(F.col("node") != F.col("head.node"))
    least = F.least("size", "head.size")
    met = rows.groupBy(F.col("head.node").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.first(least).alias("least"))
    return met.filter(F.col("n") * 200 >= F.col("least") * (100 - percent)).select("a", "b")


def _drawn(long: DataFrame, connected: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b): sets of long lists, and members of other parts drawn from the largest part of their lists,
    a few for each. The first turn draws those with the smallest share of rare members, which are linked with most
    others; other turns draw any, and more. Of parts of one size, that with such a set is taken."""
    rows = long.join(connected.toDF("node", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    rows = stored(rows, "long-parts")
    rare = 1 - F.col("rest") / F.col("size") if turn == 1 else F.lit(0.0)
    one = F.min_by(F.struct("node", "size", "rest"), F.struct(rare, F.xxhash64("node", "member", F.lit(turn)))).alias("head")
    parts = rows.groupBy("member", "part").agg(F.count(F.lit(1)).alias("n"), one)
    largest = F.struct("n", F.col("head.rest") / F.col("head.size"), "part")
    main = parts.groupBy("member").agg(F.max_by(F.struct("part", "head"), largest).alias("main"), F.count(F.lit(1)).alias("parts"))
    rows = rows.join(main.filter("parts > 1").select("member", "main.part", "main.head").toDF("member", "main", "head"), "member")
    near = F.least("size", "head.size") * 100 >= F.greatest("size", "head.size") * percent
    placed = _enough(F.least("rest", "head.rest"), F.col("size") + F.col("head.size"), percent)
    pairs = rows.filter((F.col("part") != F.col("main")) & near & placed).select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct()
    draw = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(turn))))
    return pairs.withColumn("draw", draw).filter(F.col("draw") <= DRAWS << turn - 1).select("a", "b")


def _joined_by_draws(index: DataFrame, sets: Sets, links: DataFrame) -> DataFrame:
    """(node, component) after the links (a, b) and those that turns of draws find in long lists, stored. It goes on
    while many draws are links, which joins large groups; it need not find all."""
    connected = stored(components(links), "connected")
    lists = index.groupBy("member").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LONG).select("member")
    long = stored(index.join(lists, "member"), "long")
    turn = 0
    while not long.isEmpty():
        turn += 1
        found = sets.shared(_drawn(long, connected, sets.percent, turn))
        compared, linked = found.agg(F.count(F.lit(1)), F.count_if("linked")).first()
        if linked:
            connected = stored(components(found.filter("linked").select("a", "b").union(connected.toDF("a", "b"))), "connected")
        if linked * 20 < compared or not compared:
            break
    return connected


def _grouped(links: DataFrame) -> DataFrame:
    """The links (a, b, ...) by which ``b`` joins the group of its leader ``a``: the first in hash order of those
    linked with it that come before it and have no such link themselves. One row for each ``b``."""
    order = F.xxhash64("a") < F.xxhash64("b")
    forward = links.filter(order)
    followers = forward.select(F.col("b").alias("a")).distinct()
    led = forward.join(followers, "a", "left_anti")
    first = led.groupBy("b").agg(F.min_by("a", F.xxhash64("a")).alias("a"))
    return stored(led.join(first, ["a", "b"], "left_semi"), "groups")


def _blocks(index: DataFrame, groups: DataFrame, connected: DataFrame) -> DataFrame:
    """(member, leader, part, least, most, rest) of the groups in lists that are not yet all in one part, stored."""
    named = index.join(groups.select(F.col("b").alias("node"), F.col("a").alias("leader")), "node", "left")
    named = named.withColumn("leader", F.coalesce("leader", "node"))
    blocks = named.groupBy("member", "leader").agg(F.min("size").alias("least"), F.max("size").alias("most"), F.max("rest").alias("rest"))
    blocks = blocks.join(connected.toDF("leader", "part"), "leader", "left").withColumn("part", F.coalesce("part", "leader"))
    blocks = stored(blocks, "all-blocks")
    mixed = blocks.groupBy("member").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    return stored(blocks.join(mixed.select("member"), "member", "left_semi"), "blocks")


def _open_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), in hash order, of leaders whose groups are not connected and may hold a link. Blocks meet only in
    lists of one member and of one class of size or two that follow each other, and only where enough is behind the
    member in both: so it is at the first member that two linked sets share."""
    low, high = (_size_class(F.col(c), percent) for c in ("least", "most"))
    names = ("leader", "part", "least", "most", "rest")
    left = blocks.withColumn("class", F.explode(F.sequence(low, high))).select("member", "class", *[F.col(c).alias(f"{c}_a") for c in names])
    right = blocks.withColumn("class", F.explode(F.sequence(low - 1, high + 1))).select("member", "class", *[F.col(c).alias(f"{c}_b") for c in names])
    apart = (F.col("part_a") != F.col("part_b")) & (F.xxhash64("leader_a") < F.xxhash64("leader_b"))
    sized = (F.col("most_a") * 100 >= F.col("least_b") * percent) & (F.col("most_b") * 100 >= F.col("least_a") * percent)
    key = (left["member"] == right["member"]) & (left["class"] == right["class"])
    rest, sizes = F.least("rest_a", "rest_b"), F.col("least_a") + F.col("least_b")
    placed = _enough(rest, sizes, percent)
    return left.join(right, key & apart & sized & placed).select(F.col("leader_a").alias("a"), F.col("leader_b").alias("b")).distinct()


def _derived(near: DataFrame, groups: DataFrame, sets: Sets, links: DataFrame) -> DataFrame:
    """Links (a, b) between the members of two groups, whose leaders are the pairs of ``near`` and are not
    linked, from what the leaders share."""
    percent = sets.percent
    names = ["leader", "other", "size_other", "reach_other", "least_other", "shared"]
    both = near.select("a", "b", "size_b", "reach_b", "least_b", "shared").toDF(*names)
    both = both.union(near.select("b", "a", "size_a", "reach_a", "least_a", "shared").toDF(*names))
    members = groups.select(F.col("a").alias("leader"), F.col("b").alias("x"), F.col("size_b").alias("size_x"), "more", "less")
    can = _enough(F.col("shared") + F.size("more") + F.col("reach_other"), F.col("size_x") + F.col("least_other"), percent)
    rows = stored(both.join(members, "leader").filter(can), "derived-rows")
    # A member's answer for the other leader: its leader's answer, less what it lacks, with what it has more.
    whole = sets.whole(rows.select(F.col("other").alias("node")))
    rows = rows.join(whole.toDF("other", "set_other"), "other")
    rows = rows.withColumns({"gained": _common("more", "set_other"), "lost": _common("less", "set_other")})
    rows = rows.withColumn("answer", F.col("shared") + F.col("gained") - F.col("lost"))
    rows = stored(rows.drop("set_other", "reach_other", "least_other"), "answers")
    linked = rows.filter(_enough(F.col("answer"), F.col("size_x") + F.col("size_other"), percent))
    made = stored(linked.select(F.col("x").alias("a"), F.col("other").alias("b")), "derived")

    # Members of both groups, where no link has joined the groups yet.
    parts = stored(components(links.union(made)), "parts")
    rows = rows.join(parts.toDF("leader", "part_leader"), "leader", "left").join(parts.toDF("other", "part_other"), "other", "left")
    rows = rows.filter(F.coalesce("part_leader", "leader") != F.coalesce("part_other", "other"))
    rows = stored(rows.drop("part_leader", "part_other"), "open-answers")
    y = rows.select("other", "leader", "x", "size_x", "more", "less", "answer")
    y = y.toDF("leader", "other", "y", "size_y", "more_y", "less_y", "answer_y")
    sizes = F.col("size_x") + F.col("size_y")
    can = _enough(F.least(F.col("answer") + F.size("more_y"), F.col("answer_y") + F.size("more")), sizes, percent)
    near_size = F.least("size_x", "size_y") * 100 >= F.greatest("size_x", "size_y") * percent
    pairs = rows.filter("leader > other").join(y, ["leader", "other"]).filter(near_size & can)
    # The answer of ``y`` for the leader, changed by what ``x`` has more and less than it; the other leader's
    # members are those that ``gained`` and ``lost`` counted, changed by what ``y`` has more and less.
    gained = F.col("gained") - _common("more", "less_y") + _common("more", "more_y")
    lost = F.col("lost") - _common("less", "less_y") + _common("less", "more_y")
    pairs = pairs.filter(_enough(F.col("answer_y") + gained - lost, sizes, percent))
    return stored(made.union(pairs.select(F.col("x").alias("a"), F.col("y").alias("b"))), "derived")


def _connected(index: DataFrame, sets: Sets) -> DataFrame:
    """(node, component) of the nodes that are linked with others."""
    percent = sets.percent
    found = sets.shared(_leaders(index, percent), differences=True)
    groups = _grouped(found.filter("linked"))
    links = found.filter("linked").select("a", "b")
    connected = _joined_by_draws(index, sets, links)
    todo = stored(_open_blocks(_blocks(index, groups, connected), percent), "open")
    if todo.isEmpty():
        return connected
    # How many members a group's sets have more than their leader, and the least of their sizes.
    reach = groups.groupBy(F.col("a").alias("node")).agg(F.max(F.size("more")).alias("reach"), F.min("size_b").alias("least"))
    reach = stored(reach, "reach")
    # Leaders that were compared before are not compared again.
    fresh = todo.join(found.select("a", "b"), ["a", "b"], "left_anti")
    fresh = sets.shared(sets.possible(fresh, reach))
    compared = found.select(*fresh.columns).join(todo, ["a", "b"], "left_semi").union(fresh)
    links = stored(connected.toDF("a", "b").union(fresh.filter("linked").select("a", "b")), "links")
    near = compared.filter("NOT linked")
    for side in ("a", "b"):
        near = near.join(reach.toDF(side, f"reach_{side}", f"least_{side}"), side, "left")
    near = near.filter(F.coalesce("reach_a", "reach_b").isNotNull())
    near = near.withColumns({f"least_{s}": F.least(f"size_{s}", f"least_{s}") for s in "ab"})
    near = near.fillna(0, ["reach_a", "reach_b"])
    reached = F.col("shared") + F.col("reach_a") + F.col("reach_b")
    near = stored(near.filter(_enough(reached, F.col("least_a") + F.col("least_b"), percent)), "near")
    if not near.isEmpty():
        links = links.union(_derived(near, groups, sets, links))
    return stored(components(links), "connected")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id it is linked with, over any
    number of links, itself included)."""
    texts = docs.select(quoted(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("mixed"), quoted(text_col).cast("string").alias("text"))
    kinds = {"id": texts.schema["id"].dataType, "mixed": texts.schema["mixed"].dataType}
    schema = schema_of(kinds, "size bigint, set_a bigint, set_b bigint, bucket bigint, n bigint")
    made = stored(texts.mapInArrow(tidy(digest_rows(words)), schema), "digests")
    places, common = bucket_order(made.filter("bucket IS NOT NULL"))
    made = made.filter("bucket IS NULL")
    key = ["set_a", "set_b", "size"]
    nodes = made.filter("size > 0").groupBy(*key).agg(F.min("id").alias("least_id"), F.min(F.struct("mixed", "id")).alias("place"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), *key, "least_id", "place.id", "place.mixed"), "nodes")

    schema = schema_of(kinds, "prefix array<bigint>, often int")
    prefixes = texts.mapInArrow(tidy(index_rows(words, percent, places, common)), schema)
    named = broadcast_if_small(nodes.select("node", "size", F.col("id").alias("__id"), F.col("mixed").alias("__mixed")), 64)
    prefixes = prefixes.join(named, same(F.col("id"), F.col("__id")) & (F.col("mixed") == F.col("__mixed")))
    index = _index(prefixes.select("node", "size", "prefix", "often"))
    parts = _connected(index, Sets(nodes, texts, words, percent)).toDF("node", "part")
    placed = nodes.select("node", *key, "least_id").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    placed = stored(placed, "placed")
    names = placed.groupBy("part").agg(F.min("least_id").alias("component_id"))
    named = stored(placed.join(names, "part").select(*key, "component_id"), "named")
    rows = made.select("id", *key).join(named, key, "left")
    return rows.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
