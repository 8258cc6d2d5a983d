"""BPE encoding and decoding by dynamic programming over prefixes.

The vocabulary file is one of the tokenizers library: NFC, lower case, words by a pattern, bytes written
as letters, and an end-of-word mark. For every prefix of a word there is exactly one token that the merge
order lets it end with. It is found among the tokens that an automaton of the vocabulary reports as
suffixes of the prefix: the one that fits the last token of the prefix before it. Two tokens fit if no
merge across their border would come before the merges that make them. Following these last tokens back
from the end of the word gives the ids, without replaying the merges.

Null and empty texts have no ids. Each worker keeps the ids of words it has met, in two generations of at most
``KNOWN_BYTES``, and the outcome of ``KNOWN_TESTS`` pair tests, so memory does not grow with the text.
"""

from __future__ import annotations

import gc
import json
import re
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .memory import tidy
from .shared import schema_of

KNOWN_BYTES = 12 << 20
KNOWN_TESTS = 200_000
WORD_BYTES = 320  # what a known word takes beside its letters, ids and decoded tokens
NEVER = 1 << 60
NEAR = 0x250
STEP = 200  # texts encoded at once
FINAL = 0x10000  # added to the last character of a word, in place of the end-of-word mark

# What the vocabulary files of this kind declare, beside vocabulary, merges and patterns.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be printed, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and word pattern of one file; ``source`` is its JSON text."""

    def __init__(self, source: str) -> None:
        import ahocorasick
        import regex

        self.source, self.library = source, None
        spec = json.loads(source)
        model, norms = spec["model"], [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or norms != NORMALIZERS or not model["end_of_word_suffix"]:
            raise ValueError("not a vocabulary of lower-case BPE with an end-of-word mark")
        self.mark = model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find_words = regex.compile(split).findall
        # The same pattern with its classes spelt out for the first code points, for the quicker module.
        classes = {k: [c for c in map(chr, range(NEAR)) if regex.match(k, c)] for k in (r"\p{L}", r"\p{N}", r"\s")}
        for k, found in classes.items():
            split = split.replace(k, "".join(map(re.escape, found)))
        self.find_near_words = re.compile(split).findall
        self.far = re.compile(f"[^\0-{chr(NEAR - 1)}]").search
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(added, key=len, reverse=True)
        self.find_added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.added = added
        self.tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in added.items()}
        self.letters = byte_letters()

        self.ids = {self._symbols(t): i for t, i in model["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # rank, left and right half of a merged token
        vocab = model["vocab"]
        for r, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = r
            self.parts[vocab[left + right]] = (r, a, b)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.right_edge: dict[int, list] = {}
        self.left_edge: dict[int, list] = {}
        self.fits_known: dict[int, bool] = {}
        self.known = KnownWords(self)

    def _symbols(self, token: str) -> str:
        if token.endswith(self.mark) and len(token) > len(self.mark):
            stem = token[: -len(self.mark)]
            return stem[:-1] + chr(ord(stem[-1]) + FINAL)
        return token

    def _edge(self, token: int, side: int, known: dict) -> list:
        """(symbol, rank of the merge that uses it up) from the single symbol at that edge up to the token."""
        if token not in known:
            edge, used = [(token, NEVER)], token
            while used in self.parts:
                rank, used = self.parts[used][0], self.parts[used][side]
                edge.append((used, rank))
            known[token] = edge[::-1]
        return known[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges make ``a`` and then ``b`` out of their joint symbols."""
        key = a << 32 | b
        known = self.fits_known.get(key)
        if known is None:
            left, right = self._edge(a, 2, self.right_edge), self._edge(b, 1, self.left_edge)
            i = j = 0
            known = True
            while True:
                (x, used_x), (y, used_y) = left[i], right[j]
                across = self.rank.get((x, y), NEVER)
                # At equal rank the merge further left comes first.
                if across < used_x and across <= used_y and across != NEVER:
                    known = False
                    break
                if used_x == used_y == NEVER:
                    break
                if used_x <= used_y:
                    i += 1
                else:
                    j += 1
            if len(self.fits_known) >= KNOWN_TESTS:
                self.fits_known.clear()
            self.fits_known[key] = known
        return known

    def encode_symbols(self, symbols: str) -> list[int]:
        last = [-1] * len(symbols)  # the token each prefix ends with
        size = [0] * len(symbols)
        known, fits = self.fits_known, self.fits
        for end, (length, token) in self.automaton.iter(symbols):
            if last[end] >= 0:
                continue  # the last token of a prefix is unique
            before = end - length
            if before >= 0:
                left = last[before]
                if left < 0:
                    continue
                ok = known.get(left << 32 | token)
                if ok is None:
                    ok = fits(left, token)
                if not ok:
                    continue
            last[end], size[end] = token, length
        ids, at = [], len(symbols) - 1
        while at >= 0:
            if last[at] < 0:
                raise ValueError(f"no tokens for {symbols!r}")
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word of the normalised text."""
        letters = word if word.isascii() and word.isprintable() else "".join(map(self.letters.__getitem__, word.encode()))
        return self.encode_symbols(letters[:-1] + chr(ord(letters[-1]) + FINAL))

    def decode(self, ids) -> str:
        """The tokens of the ids with a space between; files of this kind declare no decoder."""
        return " ".join([self.tokens[i] for i in ids])

    def words(self, text: str) -> list[str]:
        if self.far(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.newer_words(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case goes by single characters: no final sigma
        text = text.lower()
        return self.find_words(text) if self.far(text) else self.find_near_words(text)

    def newer_words(self, text: str) -> list[str]:
        """The words of a text with characters younger than this Python's Unicode tables: the classes and
        lower case of these are the ones of the tokenizers library."""
        from tokenizers import Tokenizer

        if self.library is None:
            self.library = Tokenizer.from_str(self.source)
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a text and the text decoded from them."""
        ids = self.text_ids(text)
        return ids, self.decode(ids.tolist())

    def text_ids(self, text: str) -> np.ndarray:
        """Ids of a text. Added tokens are found in the raw text first."""
        found, at = [], 0
        for hit in self.find_added.finditer(text) if self.find_added and "<" in text else ():
            found += map(self.known.__getitem__, self.words(text[at : hit.start()]))
            found.append(np.int32(self.added[hit.group()]).tobytes())
            at = hit.end()
        found += map(self.known.__getitem__, self.words(text[at:] if at else text))
        return np.frombuffer(b"".join(found), np.int32)


class KnownWords(dict):
    """Word to its ids as bytes; words met lately stay, in two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary, most: int = KNOWN_BYTES) -> None:
        self.vocabulary, self.most, self.size, self.older = vocabulary, most, 0, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = np.array(self.vocabulary.encode_word(word), np.int32).tobytes()
        size = WORD_BYTES + len(word) + len(found)
        if size <= self.most >> 4:
            if self.size + size > self.most:
                self.older, self.size = dict(self), 0
                self.clear()
            self[word] = found
            self.size += size
        return found


def worker_vocabulary(source: str) -> Vocabulary:
    """The vocabulary of this worker process: made once, and with it the words that earlier tasks met. It
    is kept in a module of its own, as a task's functions, and their globals, are unpickled anew each time."""
    kept = sys.modules.setdefault("tallymart_worker", types.ModuleType("tallymart_worker")).__dict__
    if kept.get("source") != source:
        kept.update(source=source, vocabulary=Vocabulary(source))
        # The tables live as long as the process; scanning them again and again would cost a third of the time.
        gc.freeze()
    return kept["vocabulary"]


def encode_rows(source: str, with_decoded: bool, text_at: int | None = None):
    """A task over (row, text), or over (row) with the text at place ``text_at`` of the row: row, then ids and, if
    asked for, the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = worker_vocabulary(source)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                row = part.column(0)
                text = part.column(1) if text_at is None else pc.struct_field(row, [text_at])
                flat = [vocabulary.text_ids(t or "") for t in text.to_pylist()]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in flat]))), pa.int32())
                columns, names = [row, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat)))], ["row", "ids"]
                if with_decoded:
                    columns, names = [*columns, pa.array([vocabulary.decode(x.tolist()) for x in flat], pa.string())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_vocabulary(path: str) -> str:
    """The file's text. It is a few megabytes and travels with the tasks, so executors need no copy."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", with_decoded: bool = False, with_text: bool = False) -> DataFrame:
    """(row, ids[, decoded]): ``row`` holds the columns of ``docs`` (the text only ``with_text``), ids the
    token ids of the whole text, decoded the text read back from them."""
    text = quoted(text_col).cast("string")
    rest = [text.alias(c) if c == text_col else quoted(c) for c in docs.columns if with_text or c != text_col]
    # The text goes to the tasks once: in the row if that holds it, else beside it.
    rows = docs.select(F.struct(*rest).alias("row"), *([] if with_text else [text.alias("text")]))
    schema = schema_of({"row": rows.schema["row"].dataType}, "ids array<int>" + ", decoded string" * with_decoded)
    text_at = docs.columns.index(text_col) if with_text else None
    return rows.mapInArrow(tidy(encode_rows(vocabulary, with_decoded, text_at)), schema)


def decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of the ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_vocabulary(vocabulary)
        for batch in batches:
            texts = [None if ids is None else words.decode(ids) for ids in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    packed = rows.select(F.struct("*").alias("row"), quoted(ids_col).alias("ids"))
    schema = schema_of({"row": packed.schema["row"].dataType}, "text string")
    return packed.mapInArrow(run, schema).select("row.*", F.col("text").alias(name))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
