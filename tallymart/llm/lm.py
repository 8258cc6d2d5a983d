"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Tokens are words (runs of bytes other than space and 0x09-0x0D, A-Z as a-z), then one end per text. The
model is a bigram with Dirichlet smoothing, P(w | h) = (c(h w) + kappa P(w)) / (c(h) + kappa), over add-one
unigrams P(w) = (c(w) + 1) / (N + V + 1): c counts training tokens, N all of them, V the distinct ones. A
text's first word has the start of a text as its context. Probabilities of bigrams are stored in 8 bits.

Work is cut into chunks of texts and shards of the vocabulary and of the contexts; both grow with the
data, so no task and no driver holds a whole model:

1. A chunk keeps its distinct words' hashes, and its texts as places in that list.
2. Chunks send each vocabulary shard their words with training counts. A shard adds them up, numbers the
   known words and answers each chunk with the counts and numbers of its words.
3. Chunks send each context shard their distinct bigrams with training counts. A shard adds them up and
   writes its trie to memory-mapped levels: contexts, pointers to their ranges and successors as
   Elias-Fano lists, 8-bit probabilities. It answers each chunk's bigrams by a successor search in the
   range of their context.
4. Chunks put the answers together per text.

A context with a share of ``HEAVY`` of all tokens or more is spread over all shards; there are at most
1 / HEAVY of these. Words are known by 64-bit hashes. Null and empty texts have only the end. With no
training text every count is 0, N = V = 0.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions._columns import quoted
from . import words as W
from .eliasfano import EliasFano
from .shared import schema_of, stored

CHUNK_BYTES = 12 << 20
SHARD_BYTES = 32 << 20
HEAVY = 1 / 1024
KAPPA = 20.0
LOG_LOW, LEVELS = -12.0, 255  # log10 of the smallest stored probability, and how many steps up to 1
END = W.U64(0x656E64)  # the end's hash; a word has it with chance 2^-64
START, UNSEEN = -1, -2  # number of the start context, and of words with no training count


def put(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), "zstd", asbytes=True) if array.nbytes else b""


def take(data: bytes, size: int, dtype) -> np.ndarray:
    if not data:
        return np.empty(0, dtype)
    return np.frombuffer(pa.decompress(data, size * np.dtype(dtype).itemsize, "zstd", asbytes=True), dtype)


# sizes: tokens of each text; words: sorted hashes; counts: their training counts; tokens: places in words.
CHUNK_COLUMNS = ["chunk", "ids", "held", "sizes", "words", "n_words", "counts", "tokens", "n_tokens"]


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, held, text): one row per chunk."""
    hasher, number = W.WordHasher(), TaskContext.get().partitionId() << 32
    for batch in batches:
        _, at = W.text_bytes(batch.column(2))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK_BYTES, side="right")) - 1)
            part = batch.slice(lo, hi - lo)
            lo, n = hi, part.num_rows
            hashes, rows = hasher(part.column(2))
            sizes = np.bincount(rows, minlength=n) + 1
            ends = np.cumsum(sizes) - 1
            tokens = np.empty(len(hashes) + n, W.U64)
            is_word = np.ones(len(tokens), bool)
            is_word[ends] = False
            tokens[is_word], tokens[ends] = hashes, END
            words, places = np.unique(tokens, return_inverse=True)
            held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(places[np.repeat(~held, sizes)], minlength=len(words))
            one = lambda x, kind: pa.array([x], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    one(number, pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)),
                    one(held.tolist(), pa.list_(pa.bool_())),
                    one(put(sizes.astype(np.int64)), pa.binary()),
                    one(put(words), pa.binary()),
                    one(len(words), pa.int64()),
                    one(put(counts.astype(np.int64)), pa.binary()),
                    one(put(places.astype(np.uint32)), pa.binary()),
                    one(len(tokens), pa.int64()),
                ],
                CHUNK_COLUMNS,
            )
            number += 1


def word_parts(bits: int):
    """A task over chunks: their words by vocabulary shard, which is the hash's first ``bits`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = take(row["words"], row["n_words"], W.U64), take(row["counts"], row["n_words"], np.int64)
                edges = np.searchsorted(words, np.arange(1 << bits, dtype=W.U64) << W.U64(64 - bits)) if bits else np.zeros(1, int)
                edges = np.append(edges, len(words))
                out = [
                    (s, row["chunk"], int(hi - lo), put(words[lo:hi]), put(counts[lo:hi]))
                    for s, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))
                    if hi > lo
                ]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("shard", "chunk", "n", "words", "counts"), x)) for x in out],
                    pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]),
                )

    return run


ANSWER = "shard bigint, chunk bigint, answer binary, n_known bigint, n_tokens bigint"
ANSWER_ARROW = pa.schema(
    [("shard", pa.int64()), ("chunk", pa.int64()), ("answer", pa.binary()), ("n_known", pa.int64()), ("n_tokens", pa.int64())]
)


def answer_words(bits: int):
    """A vocabulary shard: add up the chunks' counts, number the known words, answer every chunk with
    (count, number) of its words. The first row carries the shard's V and N."""

    def run(table: pa.Table) -> pa.Table:
        shard, sizes = table["shard"][0].as_py(), table["n"].to_numpy()
        words = np.concatenate([take(b, n, W.U64) for b, n in zip(table["words"].to_pylist(), sizes)])
        counts = np.concatenate([take(b, n, np.int64) for b, n in zip(table["counts"].to_pylist(), sizes)])
        _, places = np.unique(words, return_inverse=True)
        total = np.bincount(places, counts).astype(np.int64)
        known = total > 0
        number = np.where(known, (np.cumsum(known) - 1 << bits) | shard, UNSEEN)
        at = np.concatenate(([0], np.cumsum(sizes)))
        rows = []
        for k, chunk in enumerate(table["chunk"].to_pylist()):
            mine = places[at[k] : at[k + 1]]
            answer = put(np.concatenate((total[mine], number[mine])))
            rows.append((shard, chunk, answer, int(known.sum()) if not k else 0, int(total.sum()) if not k else 0))
        return pa.Table.from_pylist([dict(zip(ANSWER_ARROW.names, r)) for r in rows], ANSWER_ARROW)

    return run


def bigrams_of(row: dict, number: np.ndarray):
    """The chunk's distinct bigrams of known words, as (context number, word number), sorted, with the
    place of each token's bigram (or -1) and the training count of each bigram."""
    tokens = take(row["tokens"], row["n_tokens"], np.uint32)
    sizes = take(row["sizes"], len(row["ids"]), np.int64)
    heads = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[heads] = len(number)
    numbers = np.append(number, START)
    usable = (number[tokens] != UNSEEN) & (numbers[before] != UNSEEN)
    # Sorted by number, so that a context's bigrams lie together.
    back = np.argsort(numbers, kind="stable")
    rank = np.empty(len(back), np.int64)
    rank[back] = np.arange(len(back))
    key = rank[before[usable]] * len(numbers) + rank[tokens[usable]]
    pairs, place = np.unique(key, return_inverse=True)
    places = np.full(len(tokens), -1, np.int64)
    places[usable] = place
    context, word = back[pairs // len(numbers)], back[pairs % len(numbers)]
    training = np.repeat(~np.array(row["held"], bool), sizes)
    counts = np.bincount(place[training[usable]], minlength=len(pairs))
    return tokens, sizes, before, places, context, word, numbers, counts


def joined_words(row: dict, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(count, number) of each of a chunk's words, from the vocabulary shards' answers, which lie in order."""
    counts, numbers = [], []
    for a in sorted(answers, key=lambda a: a["shard"]):
        got = take(a["answer"], a["n"] * 2, np.int64)
        counts.append(got[: a["n"]]), numbers.append(got[a["n"] :])
    return np.concatenate(counts), np.concatenate(numbers)


def shard_of(context: np.ndarray, word: np.ndarray, heavy: np.ndarray, bits: int) -> np.ndarray:
    base = W.mix(context.astype(np.int64).view(W.U64) + W.U64(77))
    spread = W.mix(base + word.astype(np.int64).view(W.U64))
    return (np.where(heavy, spread, base) >> W.U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(context), np.int64)


BIGRAM_PARTS = pa.schema(
    [("shard", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("n_contexts", pa.int64())]
    + [(c, pa.binary()) for c in ("contexts", "context_counts", "runs", "words", "counts")]
)


def context_totals(count: np.ndarray, context: np.ndarray, starts: int) -> np.ndarray:
    """Training count of each context; the start counts once per training text."""
    return np.append(count, starts)[context]


def bigram_parts(bits: int, n_tokens: int, n_starts: int):
    """Cogrouped chunk and word answers: the chunk's bigrams by context shard."""

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            count, number = joined_words(row, answers.to_pylist())
            _, _, _, _, context, word, numbers, counts = bigrams_of(row, number)
            totals = context_totals(count, context, n_starts)
            shard = shard_of(numbers[context], numbers[word], totals >= HEAVY * n_tokens, bits)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
            for s in range(1 << bits):
                mine = order[edges[s] : edges[s + 1]]
                if not len(mine):
                    continue
                heads = np.flatnonzero(np.concatenate(([True], context[mine][1:] != context[mine][:-1])))
                out.append(
                    (
                        s,
                        row["chunk"],
                        len(mine),
                        len(heads),
                        put(numbers[context[mine][heads]]),
                        put(totals[mine][heads]),
                        put(np.diff(np.append(heads, len(mine))).astype(np.uint32)),
                        put(numbers[word[mine]].astype(np.int64)),
                        put(counts[mine].astype(np.uint32)),
                    )
                )
        return pa.Table.from_pylist([dict(zip(BIGRAM_PARTS.names, r)) for r in out], BIGRAM_PARTS)

    return run


class Trie:
    """One shard's bigrams: contexts, pointers and successors as Elias-Fano lists, probabilities in bytes.

    Successors are made to rise over the whole level by adding the context's place times ``width``, so a
    search is relative to the context's own range. All levels lie in one memory-mapped file."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
        """Sorted by context, then word; ``total`` is the count of each bigram's context."""
        heads = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.empty(0, np.int64)
        place = np.cumsum(np.concatenate(([False], context[1:] != context[:-1]))) if len(context) else np.empty(0, np.int64)
        self.width = int(word.max()) + 1 if len(word) else 1
        share = np.log10(count / (total + KAPPA)) if len(count) else np.empty(0)
        levels = [
            EliasFano.of(context[heads] + 1),  # the start is -1
            EliasFano.of(np.append(heads, len(context))),
            EliasFano.of(place * self.width + word),
        ]
        codes = (1 + np.clip(np.rint((1 - share / LOG_LOW) * (LEVELS - 1)), 0, LEVELS - 1)).astype(np.uint8)
        arrays = [x for level in levels for x in level.arrays()] + [codes]
        self.file = tempfile.NamedTemporaryFile(prefix="trie-")
        places = []
        for x in arrays:
            places.append((self.file.tell(), x.dtype, x.shape))
            self.file.write(np.ascontiguousarray(x).tobytes())
            self.file.write(b"\0" * (-self.file.tell() % 64))
        self.file.write(b"\0" * 64)
        self.file.flush()
        self.bytes = os.path.getsize(self.file.name)
        mapped = np.memmap(self.file.name, np.uint8, "r").view(np.ndarray)  # reads of a plain array cost less
        views = [mapped[at : at + int(np.prod(shape)) * kind.itemsize].view(kind).reshape(shape) for at, kind, shape in places]
        for k, level in enumerate(levels):
            level.low, level.high, level.samples = views[3 * k : 3 * k + 3]
        self.contexts, self.pointers, self.successors = levels
        self.codes = views[-1]

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each bigram, 0 if it was not seen in training. Bigrams of a context that follow one another
        share one search for it."""
        n = self.contexts.size
        out = np.zeros(len(context), np.uint8)
        if not n or not len(context):
            return out
        firsts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        runs = np.diff(np.append(firsts, len(context)))
        wanted = (context[firsts] + 1).astype(W.U64)
        place = self.contexts.successor(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), n))
        held = np.flatnonzero(place < n)
        held = held[self.contexts.at(place[held]) == wanted[held]]
        lo, hi = (np.repeat(self.pointers.at(place[held] + k).astype(np.int64), runs[held]) for k in (0, 1))
        is_held = np.zeros(len(firsts), bool)
        is_held[held] = True
        found = np.flatnonzero(np.repeat(is_held, runs))
        place = np.repeat(place[held], runs[held])
        value = (place * self.width + word[found]).astype(W.U64)
        known = word[found] < self.width
        at = self.successors.successor(value, lo, hi)
        hit = known & (at < hi)
        hit[hit] = self.successors.at(at[hit]) == value[hit]
        out[found[hit]] = self.codes[at[hit]]
        return out


def answer_bigrams(table: pa.Table) -> pa.Table:
    """A context shard: build its trie from the chunks' counts, then answer every chunk's bigrams."""
    rows = table.to_pylist()
    contexts, words, counts, totals = [], [], [], []
    for r in rows:
        runs = take(r["runs"], r["n_contexts"], np.uint32)
        contexts.append(np.repeat(take(r["contexts"], r["n_contexts"], np.int64), runs))
        totals.append(np.repeat(take(r["context_counts"], r["n_contexts"], np.int64), runs))
        words.append(take(r["words"], r["n"], np.int64))
        counts.append(take(r["counts"], r["n"], np.uint32))
    context, word, count, total = map(np.concatenate, (contexts, words, counts, totals))
    order = np.lexsort((word, context))
    new = np.ones(len(order), bool)
    new[1:] = (context[order][1:] != context[order][:-1]) | (word[order][1:] != word[order][:-1])
    heads = order[new]
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(new) - 1
    summed = np.bincount(places, count).astype(np.int64)
    seen = summed > 0
    trie = Trie(context[heads][seen], word[heads][seen], summed[seen], total[heads][seen])
    codes = trie.codes_of(context[heads], word[heads])[places]
    at, out = 0, []
    for k, r in enumerate(rows):
        out.append((r["shard"], r["chunk"], put(codes[at : at + r["n"]]), len(trie.codes) if not k else 0, trie.bytes if not k else 0))
        at += r["n"]
    trie.file.close()
    return pa.Table.from_pylist([dict(zip(ANSWER_ARROW.names, x)) for x in out], ANSWER_ARROW)


def score_rows(bits: int, n_tokens: int, n_distinct: int, n_starts: int, id_type: pa.DataType):
    """Cogrouped chunk and all answers (level 1: words, level 2: bigrams): the texts' scores."""

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            got = answers.to_pylist()
            count, number = joined_words(row, [a for a in got if a["level"] == 1])
            tokens, sizes, before, places, context, word, numbers, _ = bigrams_of(row, number)
            totals = context_totals(count, context, n_starts)
            shard = shard_of(numbers[context], numbers[word], totals >= HEAVY * n_tokens, bits)
            order = np.argsort(shard, kind="stable")
            codes = np.zeros(len(context) + 1, np.uint8)
            at = 0
            for a in sorted((a for a in got if a["level"] == 2), key=lambda a: a["shard"]):
                n = int(np.searchsorted(shard[order], a["shard"], "right")) - at
                codes[order[at : at + n]] = take(a["answer"], n, np.uint8)
                at += n
            share = np.where(codes, 10.0 ** ((1 - (codes.astype(float) - 1) / (LEVELS - 1)) * LOG_LOW), 0.0)
            base = (count[tokens] + 1) / (n_tokens + n_distinct + 1)
            of_context = np.append(np.where(number == UNSEEN, 0, count), n_starts)[before]
            full = share[places] + KAPPA / (of_context + KAPPA) * base
            heads = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            sums = [np.add.reduceat(x, heads) for x in (np.log10(base), np.log10(full), (count[tokens] > 0).astype(np.int64))]
            out.append(
                pa.Table.from_arrays(
                    [pa.array(row["ids"], id_type), pa.array(row["held"]), pa.array(sizes), pa.array(sums[2])]
                    + [pa.array(np.full(len(sizes), n_tokens)), pa.array(sums[0]), pa.array(sums[1])],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
            )
        return pa.concat_tables(out)

    return run


def bits_for(size: float, least: int) -> int:
    """log2 of the number of shards: enough for SHARD_BYTES each, and ``least`` of them."""
    return max(int(np.ceil(size / SHARD_BYTES)), least, 1).bit_length()


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score. The
    model learns from the rows for which the column ``held_out`` is not true."""
    spark = docs.sparkSession
    rows = docs.select(
        quoted(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), quoted(text_col).cast("string").alias("text")
    )
    id_type = rows.schema["id"].dataType
    schema = schema_of(
        {"chunk": T.LongType(), "ids": T.ArrayType(id_type)},
        "held array<boolean>, sizes binary, words binary, n_words bigint, counts binary, tokens binary, n_tokens bigint",
    )
    chunks = rows.mapInArrow(chunk_rows, schema)
    chunks = stored(chunks, "chunks")
    least = max(spark.sparkContext.defaultParallelism, 1)
    size = chunks.agg(F.sum("n_words")).first()[0] or 0
    starts = chunks.select(F.explode("held").alias("held")).filter("NOT held").count()

    bits = bits_for(size * 16, least)
    parts = chunks.select("chunk", "n_words", "words", "counts").mapInArrow(
        word_parts(bits), "shard bigint, chunk bigint, n bigint, words binary, counts binary"
    )
    parts = stored(parts, "word-parts")
    answers = stored(parts.groupBy("shard").applyInArrow(answer_words(bits), ANSWER), "word-answers")
    known, total = answers.agg(F.sum("n_known"), F.sum("n_tokens")).first()
    known, total = known or 0, total or 0
    sized = answers.join(parts.select("shard", "chunk", "n"), ["shard", "chunk"]).select("shard", "chunk", "n", "answer")

    # A chunk's bigrams are no more than its tokens; they and their merge take 24 bytes each.
    n_tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    wide = bits_for(n_tokens * 16, least)
    pairs = chunks.groupBy("chunk").cogroup(sized.groupBy("chunk")).applyInArrow(
        bigram_parts(wide, total, starts), "shard bigint, chunk bigint, n bigint, n_contexts bigint, contexts binary, context_counts binary, runs binary, words binary, counts binary"
    )
    codes = pairs.groupBy("shard").applyInArrow(answer_bigrams, ANSWER)
    codes = stored(codes.select("shard", "chunk", "answer"), "bigram-answers")
    both = sized.select(F.lit(1).alias("level"), "shard", "chunk", "n", "answer").union(
        codes.select(F.lit(2).alias("level"), "shard", "chunk", F.lit(0).cast("bigint"), "answer")
    )
    added = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    out = schema_of({"id": id_type}, added)
    scored = chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(
        score_rows(wide, total, known, starts, to_arrow_type(id_type)), out
    )
    return scored.withColumnRenamed("id", id_col)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
