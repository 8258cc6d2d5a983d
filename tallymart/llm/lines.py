"""Line dedup within one word edit, by deletion neighbourhoods.

A line's words are runs of bytes other than space and 0x09-0x0D, with A-Z as a-z; two lines are near if
one word added, taken away or replaced turns one's words into the other's. Lines without a word always
stay; from ``FUZZY_WORDS`` words on near lines count as repeats, below only equal ones, as any two lines of
one word are near, and those of two words may share no more than they differ in. A line in a script without
spaces is one word. A line goes if an equal or near line comes earlier, by (doc id, line number); whether
that line itself goes does not matter, so the result does not depend on any order of work.

1. Equal lines become one, with their first place (a grouped minimum).
2. A line can only be near another if both share the first or the last half of their words, for the
   smaller of their word counts m: each line emits these two for m = n and n - 1. Lines that share none
   are left out of what follows; no near pair is lost.
3. The others emit all their variants: the whole line, and the line without each one of its words, as
   hashes. Lines with one variant at one place differ in that word only; a line that equals a variant
   lacks that word. So the earliest line of each (variant, place) and of each variant is all that needs
   to be joined, and a group of any size emits no pairs.
4. The edit distance of each line and its earlier partner is verified on their words.

Null and empty texts have no lines. Rows of one id and one text are one document.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import quoted
from . import words as W
from .shared import broadcast_if_small, same, schema_of, stored, whole_text

MIN_WORDS, FUZZY_WORDS = 1, 3
P = W.U64(0x9DDFEA08EB382D69)


def _rolling(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and the sums of words times powers, for hashes of any run of words."""
    powers = np.full(len(words) + 1, P, W.U64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate((np.zeros(1, W.U64), np.cumsum(words * powers[: len(words)])))
    return powers, sums


class Lines:
    """Word hashes of all lines of a column of texts."""

    def __init__(self, column: pa.Array, hasher: W.WordHasher) -> None:
        data, at = W.text_bytes(column)
        breaks = np.flatnonzero(data == 10)
        starts = np.sort(np.concatenate((at[:-1], breaks + 1)), kind="stable")
        # A break at the very end of a text opens an empty line there, as a split does.
        row = np.repeat(np.arange(len(column)), np.bincount(np.searchsorted(at, breaks, "right") - 1, minlength=len(column)) + 1)
        first = np.searchsorted(row, np.arange(len(column)))
        text = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        )
        self.row, self.number = row, np.arange(len(row)) - first[row]
        self.words, self.of = hasher(text)
        self.count = np.bincount(self.of, minlength=len(row))
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.powers, self.sums = _rolling(self.words)
        inverse = W.U64(pow(int(P), -1, 1 << 64))
        steps = np.full(len(self.words) + 1, inverse, W.U64)
        steps[0] = 1
        self.inverses = np.multiply.accumulate(steps)

    def run_hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Sum of the words lo .. hi, the first one counted once, the next P times, and so on."""
        return (self.sums[hi] - self.sums[lo]) * self.inverses[lo]


def hash_line(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return W.mix(total + W.mix(count.astype(W.U64))).view(np.int64)


def line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, mixed, number, line hash, word count, half keys) of each line of MIN_WORDS or more."""
    hasher = W.WordHasher()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lines = Lines(part.column(2), hasher)
            mine = np.flatnonzero(lines.count >= MIN_WORDS)
            n, lo = lines.count[mine], lines.first[mine]
            hi = lo + n
            keys = []
            for less in (0, 1):
                m = n - less
                half = m // 2
                tag = W.mix(m.astype(W.U64))
                keys.append(W.mix(lines.run_hash(lo, lo + half) ^ tag))
                keys.append(W.mix(lines.run_hash(hi - (m - half), hi) ^ ~tag))
            fuzzy = n >= FUZZY_WORDS
            flat = np.stack(keys, 1)[fuzzy].ravel().view(np.int64) if len(mine) else np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum(np.where(fuzzy, 4, 0))))
            rows = pa.array(lines.row[mine])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(rows),
                    part.column(1).take(rows),
                    pa.array(lines.number[mine].astype(np.int32)),
                    pa.array(hash_line(lines.run_hash(lo, hi), n)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                ["doc", "mixed", "number", "line", "halves"],
            )


def variant_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (line, doc, mixed, number, text): one row per variant, (variant, place, line, doc, mixed, number).

    Place -1 is the whole line, else it is the place of the word taken away."""
    hasher = W.WordHasher()
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            words, of = hasher(part.column(4))
            n = np.bincount(of, minlength=part.num_rows)
            first = np.concatenate(([0], np.cumsum(n)))
            powers, sums = _rolling(words)
            inverses = np.full(len(words) + 2, W.U64(pow(int(P), -1, 1 << 64)), W.U64)
            inverses[0] = 1
            inverses = np.multiply.accumulate(inverses)
            here = np.arange(len(words))
            lo, hi = first[of], first[of + 1]
            head = (sums[here] - sums[lo]) * inverses[lo]
            # The words after the one taken away move one place to the left.
            tail = (sums[hi] - sums[here + 1]) * inverses[lo + 1]
            variant = hash_line(head + tail, n[of] - 1)
            whole = hash_line((sums[first[1:]] - sums[first[:-1]]) * inverses[first[:-1]], n)
            row = np.concatenate((np.arange(part.num_rows), of))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((whole, variant))),
                    pa.array(np.concatenate((np.full(part.num_rows, -1), here - lo)).astype(np.int32)),
                    *[part.column(c).take(take) for c in (0, 1, 2, 3)],
                ],
                ["variant", "place", "line", "doc", "mixed", "number"],
            )


def picked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc, mixed, text, wanted numbers and hashes): the wanted lines' texts."""
    for batch in batches:
        out = []
        for doc, mixed, text, wanted in zip(*[c.to_pylist() for c in batch.columns]):
            lines = (text or "").split("\n")
            out += [(w["line"], doc, mixed, w["number"], lines[w["number"]]) for w in wanted]
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int64(), batch.schema.field(0).type, pa.int64(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["line", "doc", "mixed", "number", "text"])


def near(a: list[str], b: list[str]) -> bool:
    """Whether one word added, taken away or replaced turns one list into the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    head = next((i for i in range(least) if a[i] != b[i]), least)
    tail = next((i for i in range(least - head) if a[-1 - i] != b[-1 - i]), least - head)
    return head + tail >= max(len(a), len(b)) - 1


def verified_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (line, text, earlier text): the lines whose words are at most one edit apart."""
    to_lower = {c: c + 32 for c in range(65, 91)}

    def words(text: str) -> list[str]:
        for blank in "\t\n\x0b\x0c\r":
            text = text.replace(blank, " ")
        return [w for w in text.translate(to_lower).split(" ") if w]

    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        real = [near(words(a), words(b)) for a, b in pairs]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(real, pa.bool_()))], ["line"])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, mixed, number): the lines that go, numbered from 0 in their text; ``mixed`` is the text's hash."""
    texts = docs.select(
        quoted(id_col).alias("doc"), F.xxhash64(whole_text(text_col)).alias("mixed"), whole_text(text_col).alias("text")
    )
    id_type = texts.schema["doc"].dataType
    schema = schema_of({"doc": id_type}, "mixed bigint, number int, line bigint, halves array<bigint>")
    places = stored(texts.mapInArrow(line_rows, schema), "lines")
    place = F.struct("doc", "mixed", "number")
    lines = places.groupBy("line").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves")
    )
    lines = stored(lines, "distinct-lines")

    shared = lines.select("line", F.explode("halves").alias("half")).groupBy("half")
    shared = shared.agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("low"), F.max("line").alias("high"))
    shared = stored(shared.filter("low <> high").select("half"), "halves")
    able = lines.select("line", "first", F.explode("halves").alias("half")).join(broadcast_if_small(shared, 16), "half", "left_semi")
    able = stored(able.groupBy("line").agg(F.first("first").alias("first")), "able")

    wanted = able.select("line", "first.*").groupBy("doc", "mixed").agg(F.collect_list(F.struct("number", "line")).alias("wanted"))
    wanted = stored(wanted.select(F.col("doc").alias("d"), F.col("mixed").alias("m"), "wanted"), "wanted")
    match = same(F.col("doc"), F.col("d")) & (F.col("mixed") == F.col("m"))
    chosen = texts.join(broadcast_if_small(wanted), match).select("doc", "mixed", "text", "wanted")
    kinds = {"line": T.LongType(), "doc": id_type, "mixed": T.LongType(), "number": T.IntegerType()}
    # Repeated rows name the same line twice.
    able_texts = chosen.mapInArrow(picked_rows, schema_of(kinds, "text string"))
    able_texts = stored(able_texts.groupBy("line", "doc", "mixed", "number").agg(F.first("text").alias("text")), "able-lines")
    order = able_texts.select("line", "doc", "mixed", "number", "text")
    variants = order.mapInArrow(variant_rows, schema_of({"variant": T.LongType(), "place": T.IntegerType(), **kinds}))
    # Most variants belong to one line alone. The rest is what two or more lines share.
    common = variants.groupBy("variant").agg(F.min("line").alias("low"), F.max("line").alias("high"))
    common = stored(common.filter("low <> high").select("variant"), "common-variants")
    variants = stored(variants.join(broadcast_if_small(common, 16), "variant", "left_semi"), "variants")

    own = F.struct("doc", "mixed", "number", "line").alias("own")
    variants = variants.select("variant", "place", "line", own)
    shorter = variants.filter("place >= 0")
    by_place = shorter.groupBy("variant", "place").agg(F.min("own").alias("earlier"))
    pairs = shorter.join(by_place, ["variant", "place"]).filter("earlier < own").select("line", "earlier.line")
    pairs = pairs.toDF("line", "partner")
    # A line and one that lacks a word: the later of the two goes.
    whole = variants.filter("place < 0").select("variant", F.col("own").alias("whole"))
    with_whole = shorter.join(whole, "variant")
    longer_goes = with_whole.filter("whole < own").select("line", F.col("whole.line").alias("partner"))
    by_variant = with_whole.filter("own < whole").groupBy("variant").agg(F.min("own").alias("earlier"))
    shorter_goes = by_variant.select(F.col("variant").alias("line"), F.col("earlier.line").alias("partner"))
    pairs = pairs.union(longer_goes).union(shorter_goes).distinct()
    mine = able_texts.select("line", "text")
    sides = pairs.join(mine, "line").join(mine.toDF("partner", "earlier_text"), "partner").select("line", "text", "earlier_text")
    gone = stored(sides.mapInArrow(verified_rows, "line bigint").distinct(), "near-lines")

    repeats = lines.join(gone.withColumn("near", F.lit(True)), "line", "left").filter("n > 1 OR near")
    repeats = repeats.select("line", "first", F.coalesce("near", F.lit(False)).alias("near"))
    found = places.select("line", "doc", "mixed", "number").join(repeats, "line")
    return found.filter(F.col("near") | ~same(F.col("first"), place)).select("doc", "mixed", "number")


def without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (row, text, gone): row, text without the gone lines, lines before, lines left."""
    for batch in batches:
        texts, before, left = [], [], []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = text.split("\n") if text else []
            dropped = set(gone or ())
            kept = [x for i, x in enumerate(lines) if i not in dropped]
            texts.append(None if text is None else "\n".join(kept))
            before.append(len(lines)), left.append(len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(left, pa.int64())],
            ["row", "kept_text", "n_lines", "n_kept"],
        )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, kept_text, n_lines, n_kept): ``row`` holds the columns of ``docs`` but the text; kept_text is the
    text without repeated lines (null for a null text)."""
    gone = repeated_lines(docs, id_col, text_col).groupBy("doc", "mixed").agg(F.collect_set("number").alias("gone"))
    gone = stored(gone.select(F.col("doc").alias("d"), F.col("mixed").alias("m"), "gone"), "gone-lines")
    rest = F.struct(*[quoted(c) for c in docs.columns if c != text_col])
    rows = docs.select(
        rest.alias("row"), quoted(text_col).cast("string").alias("text"), quoted(id_col).alias("doc"), F.xxhash64(whole_text(text_col)).alias("mixed")
    )
    match = same(F.col("doc"), F.col("d")) & (F.col("mixed") == F.col("m"))
    joined = rows.join(broadcast_if_small(gone), match, "left").select("row", "text", "gone")
    schema = schema_of({"row": joined.schema["row"].dataType}, "kept_text string, n_lines bigint, n_kept bigint")
    return joined.mapInArrow(without_lines, schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
