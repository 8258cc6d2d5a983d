"""Language identification of mixed text.

Learning counts, per language, hashed letter triples of its words (with word ends) and its letters per
script, over all labelled rows; the counts are summed in tasks before they are shuffled. The model is a
table of bounded size: 2^bits buckets for each of at most ``max_langs`` languages.

Prediction cuts a text into words (runs of letters). The script of a word, found from code point ranges,
leaves only the languages that write in it. Each word gets a log probability per remaining language,
and Viterbi with a price for each switch of language labels the words; runs of one label are spans.

A text's language is the one with most letters in its spans; its score is that share of the letters.
Null, empty and letterless texts have no span, the language ``und`` and score 0. A word in a script no
language was learned in leaves every language open. Texts are read whole: a long one is looked at in
pieces that end between words, however long a word is, and Viterbi runs over all its words.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .memory import tidy
from .shared import schema_of

UNKNOWN = "und"

# Code point ranges of scripts, first and last.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}

TABLE = 0x32400  # code points above hold no letters
PIECE = 1 << 18  # characters looked at in one step


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    weights: np.ndarray  # buckets x languages, log probability of a letter triple
    open_to: np.ndarray  # scripts x languages, whether the language writes in the script
    bits: int
    switch_cost: float


class Reader:
    """Finds the words of texts and what each letter triple hashes to."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        points = [chr(c) if not 0xD800 <= c <= 0xDFFF else " " for c in range(TABLE)]
        self.letter = np.array([c.isalpha() for c in points])
        self.within = self.letter | np.array([unicodedata.category(c)[0] == "M" for c in points])
        self.lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in points], np.uint32)
        self.script = np.zeros(TABLE, np.uint8)
        for k, ranges in enumerate(SCRIPTS.values(), 1):
            for first, last in ranges:
                self.script[first : last + 1] = k

    def words(self, texts: list[str]):
        """For the words of all texts: row, start and end (code points), letters, script, and the hashed
        triples with the index of each word's first one."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(points < TABLE, points, 0)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        within = self.within[points]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], within))))
        starts, ends = edges[::2], edges[1::2]
        letters = np.concatenate(([0], np.cumsum(self.letter[points])))
        count = letters[ends] - letters[starts]
        real = count > 0
        starts, ends, count = starts[real], ends[real], count[real]
        x = np.where(within, self.lower[points], 0).astype(np.uint64)
        before = np.concatenate((np.zeros(2, np.uint64), x))
        hashed = (before[:-2] * np.uint64(0x9E3779B97F4A7C15) + before[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (
            x * np.uint64(0xD6E8FEB86659FD93)
        )
        hashed = ((hashed ^ (hashed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)) >> self.shift
        # A word's triples end at each of its characters and at the first one after it.
        sizes = ends - starts + 1
        firsts = np.concatenate(([0], np.cumsum(sizes)))
        index = np.arange(firsts[-1]) + np.repeat(starts - firsts[:-1], sizes)
        rows = np.searchsorted(begins, starts, side="right") - 1
        return rows, starts - begins[rows], ends - begins[rows], count, self.script[points[starts]], hashed[index], firsts


def in_word(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


def cut(text: str, at: int) -> int:
    """Where a piece of about PIECE characters from ``at`` on ends: before it comes a character that no word holds. A
    word that is longer than that stays whole."""
    end = at + PIECE
    if end >= len(text):
        return len(text)
    while end > at and in_word(text[end - 1]):
        end -= 1
    if end == at:
        end = at + PIECE
        while end < len(text) and in_word(text[end]):
            end += 1
    return end


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Groups of about PIECE characters: row and offset of each piece, and the pieces. Long texts are cut between
    words."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = cut(text, at)
            rows.append(row), offsets.append(at), parts.append(text[at:end])
            size += end - at
            at = end
            if size >= PIECE:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def count_features(bits: int):
    """A task over (lang, text): (lang, bucket, n); buckets from 2^bits on count letters per script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, sums = Reader(bits), {}
        width = (1 << bits) + len(SCRIPTS) + 1
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                mine = [t for t, of in zip(texts, langs) if of == lang]
                total = sums.setdefault(lang, np.zeros(width, np.int64))
                for _, _, parts in pieces(mine):
                    _, _, _, letters, script, hashed, _ = reader.words(parts)
                    total[: 1 << bits] += np.bincount(hashed.astype(np.int64), minlength=1 << bits)
                    total[1 << bits :] += np.bincount(script, letters, len(SCRIPTS) + 1).astype(np.int64)
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], ["lang", "bucket", "n"]
            )

    return run


def packed_numbers(numbers: Column) -> Column:
    """An array of whole numbers, not negative, as eight bytes each, the highest first."""
    return F.unhex(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 18,
    max_langs: int = 64,
    min_share: float = 0.001,
    switch_cost: float = 12.0,
) -> Model:
    """Learn from every row with a language. What reaches the driver is at most 2^bits + 22 counts for
    each of ``max_langs`` languages, 256 at most; more labels than that are an error, so no language is
    left out. A language writes in a script if at least ``min_share`` of its letters are of it."""
    if not 0 < max_langs <= 256:
        raise ValueError(f"max_langs is {max_langs}; labels of words are bytes, so it is 1 to 256")
    rows = labelled.filter(quoted(lang_col).isNotNull()).select(
        quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text")
    )
    counts = rows.mapInArrow(tidy(count_features(bits)), "lang string, bucket bigint, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # A language's counts reach the driver as two binaries, of eight bytes a count each.
    pairs = F.array_sort(F.collect_list(F.struct("bucket", "n")))
    packed = counts.groupBy("lang").agg(pairs.alias("counts"))
    columns = [packed_numbers(F.col(f"counts.{c}")).alias(c) for c in ("bucket", "n")]
    found = sorted(packed.select("lang", *columns).limit(max_langs + 1).collect(), key=lambda r: r.lang)
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} languages are labelled; raise max_langs or leave some out")
    size, kinds = 1 << bits, len(SCRIPTS) + 1
    table = np.zeros((size + kinds, len(found)))
    for k, row in enumerate(found):
        table[np.frombuffer(row.bucket, ">i8"), k] = np.frombuffer(row.n, ">i8")
    triples, letters = table[:size], table[size:]
    weights = np.log((triples + 0.5) / (triples.sum(0) + 0.5 * size)).astype(np.float32)
    share = letters / np.maximum(letters.sum(0), 1)
    open_to = share >= min_share
    open_to[~open_to.any(1)] = True
    return Model(tuple(r.lang for r in found), weights, open_to, bits, switch_cost)


def viterbi(scores: np.ndarray, sizes: np.ndarray, cost: float) -> np.ndarray:
    """The best label of every word. ``scores`` is words x labels, ``sizes`` the words of each text; all
    texts move one word forward at a time, the longest ones alone at the end."""
    n, labels = scores.shape
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(sizes) else []
    best = np.zeros((len(sizes), labels))
    top = np.zeros(n, np.uint8)  # best label of the word before
    moved = np.zeros((n, labels), bool)  # whether the best way to a label comes from ``top``
    for t, k in enumerate(active):
        at = first[:k] + t
        if t:
            peak = best[:k].argmax(1)
            value = best[np.arange(k), peak][:, None] - cost
            top[at], moved[at] = peak, value > best[:k]
            np.maximum(best[:k], value, out=best[:k])
        best[:k] += scores[at]
    label = np.zeros(n, np.uint8)
    now = np.zeros(len(sizes), np.int64)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        done = sizes[:k] == t + 1
        now[:k][done] = best[:k][done].argmax(1)
        label[at] = now[:k]
        now[:k] = np.where(moved[at, now[:k]], top[at], now[:k])
    return label


def label_rows(model: Model, with_text: bool = False):
    """A task over (…, text last): the other columns (the text only ``with_text``), then lang_pred, score and spans."""

    def labelled(reader: Reader, texts: list[str]):
        found = []
        for rows, offsets, parts in pieces(texts) if model.langs else ():
            piece, start, end, letters, script, hashed, firsts = reader.words(parts)
            if not len(piece):
                continue
            score = np.add.reduceat(model.weights[hashed.astype(np.int64)], firsts[:-1], axis=0)
            score = np.where(model.open_to[script], score, score.min() - 1e3)
            offset = np.array(offsets)[piece]
            found.append((np.array(rows)[piece], start + offset, end + offset, letters, score))
        n, k = len(texts), len(model.langs)
        if not found:
            empty = pa.array([[]] * n, SPANS)
            return pa.array([UNKNOWN] * n), pa.array(np.zeros(n)), empty
        row, start, end, letters, score = (np.concatenate(c) for c in zip(*found))
        label = viterbi(score, np.bincount(row, minlength=n), model.switch_cost)
        weight = np.bincount(row * k + label, letters, n * k).reshape(n, k)
        total = weight.sum(1)
        langs = np.array([*model.langs, UNKNOWN], object)
        pred = langs[np.where(total > 0, weight.argmax(1), k)]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
        heads = np.flatnonzero(new)
        tails = np.concatenate((heads[1:], [len(row)])) - 1
        at = np.concatenate(([0], np.cumsum(np.bincount(row[heads], minlength=n))))
        spans = pa.StructArray.from_arrays(
            [pa.array(langs[label[heads]], pa.string()), pa.array(start[heads]), pa.array(end[tails])],
            fields=list(SPANS.value_type),
        )
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)
        return pa.array(pred, pa.string()), pa.array(weight.max(1) / np.maximum(total, 1)), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.bits)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                passed = part.num_columns if with_text else part.num_columns - 1
                names = [*part.schema.names[:passed], "lang_pred", "score", "spans"]
                yield pa.RecordBatch.from_arrays([*part.columns[:passed], *labelled(reader, texts)], names)

    return run


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def label_spans(docs: DataFrame, model: Model, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(row[, text], lang_pred, score, spans): ``row`` holds all columns of ``docs`` but the text, which is
    sent back only ``with_text``; spans are (lang, start, end) in code points, end exclusive, from the first letter of a
    span to the last."""
    rest = F.struct(*[quoted(c) for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("row"), quoted(text_col).cast("string").alias("text"))
    added = "lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>"
    schema = schema_of({"row": rows.schema["row"].dataType}, "text string, " * with_text + added)
    return rows.mapInArrow(tidy(label_rows(model, with_text)), schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
