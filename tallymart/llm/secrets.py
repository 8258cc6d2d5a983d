r"""Secret scans with DataFrame functions only: fixed patterns, and random-looking tokens.

Patterns (leftmost, not overlapping per kind): ``assign``, a key word with a value of 12 or more signs;
``access``, AKIA with 14 or more of A-Z0-9; ``hex``, 16 or more of 0-9a-f. ``random`` spans are added for
tokens of ``MIN_TOKEN`` or more of A-Za-z0-9+/_=- that two character Markov models tell apart: the mean
log-likelihood ratio per step, model of random strings against model of ordinary identifiers, is at least
``threshold``. A random span is not given where the token is the value of a key word or holds an
``access`` or ``hex`` span.

The models are first-order over ASCII with add-one smoothing, two tables of 128 x 128 counts learned from
labelled samples of at most ``MOST_SAMPLES`` strings each (documented bound); nothing else is sampled.

No pattern spans a line break. Offsets are code points, end exclusive. Each text is scanned in place, so
a scan needs no shuffle. Null and empty texts have no span.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import whole_text

KINDS = ["assign", "access", "hex", "random"]
# The base patterns; \x22 and \x27 are the quotation marks.
ASSIGN_HEAD = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]+"
MIN_VALUE = 12
# The look-behind changes no match; it spares a run the tries from its middle.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"

MIN_TOKEN = 16
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN
MOST_SAMPLES = 20_000
RUN = 512  # lengths summed at a time


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def prefix_sums(lengths: str) -> str:
    """SQL: for each entry of an int array, the sum of the entries before it. Sums are taken in runs and
    over the runs' totals, as appending to one long array would copy it again and again."""

    def scan(array: str) -> str:
        step = "(t, x) -> struct(t.s + x AS s, array_append(t.a, t.s) AS a)"
        return f"aggregate({array}, struct(0 AS s, cast(array() AS array<int>) AS a), {step}, t -> t.a)"

    runs = f"transform(sequence(0, (size({lengths}) - 1) div {RUN}), b -> slice({lengths}, b * {RUN} + 1, {RUN}))"
    totals = "transform(runs, r -> aggregate(r, 0, (s, x) -> s + x))"
    summed = f"flatten(transform(runs, (r, i) -> transform({scan('r')}, x -> x + offsets[i])))"
    bound = f"transform(array({runs}), runs -> transform(array({scan(totals)}), offsets -> {summed})[0])[0]"
    return f"if(size({lengths}) > 0, {bound}, cast(array() AS array<int>))"


def add_spans(rows: DataFrame, name: str, pattern: str) -> DataFrame:
    """Add ``name``: (start, end, value, before) of each match of ``pattern`` in ``text``; ``before`` is up
    to 40 characters since the match before. The parts of a split lie between the matches, so the
    lengths of both give the places."""
    found, gaps, sizes, sums = (f"{name}_{x}" for x in ("found", "gaps", "sizes", "sums"))
    rows = rows.withColumn(found, F.expr(f"regexp_extract_all(text, {literal(pattern)}, 0)"))
    rows = rows.withColumn(gaps, F.expr(f"if(size({found}) > 0, split(text, {literal(pattern)}), cast(array() AS array<string>))"))
    rows = rows.withColumn(sizes, F.expr(f"transform({found}, (m, i) -> char_length({gaps}[i]) + char_length(m))"))
    rows = rows.withColumn(sums, F.expr(prefix_sums(sizes)))
    one = (
        f"struct({sums}[i] + char_length({gaps}[i]) AS start, {sums}[i] + {sizes}[i] AS end, "
        f"m AS value, right({gaps}[i], 40) AS before)"
    )
    return rows.withColumn(name, F.expr(f"transform({found}, (m, i) -> {one})")).drop(found, gaps, sizes, sums)


def base_spans(docs: DataFrame) -> DataFrame:
    """Add assign, access, hex, arrays of spans, to a table with a ``text``."""
    docs = add_spans(docs, "assign", f"{ASSIGN_HEAD}{ASSIGN_VALUE}")
    value = f"regexp_extract(s.value, {literal(f'^{ASSIGN_HEAD}({ASSIGN_VALUE})$')}, 1)"
    docs = docs.withColumn("assign", F.expr(f"filter(assign, s -> char_length({value}) >= {MIN_VALUE})"))
    return add_spans(add_spans(docs, "access", ACCESS), "hex", HEX)


def steps(token: str) -> str:
    """SQL: for each neighbouring pair of ASCII characters of ``token``, 128 * first + second. The token is split
    once and its characters meet their followers, so a long one costs no more a character than a short one."""
    codes = f"transform(split({token}, ''), c -> ascii(c))"
    pairs = "zip_with(slice(codes, 1, size(codes) - 1), slice(codes, 2, size(codes) - 1), (a, b) -> a * 128 + b)"
    return f"transform(array({codes}), codes -> {pairs})[0]"


def fit(samples: DataFrame, text_col: str = "text", random_col: str = "is_random") -> np.ndarray:
    """The log-likelihood ratio of each character step, 128 * first + second, from labelled samples (text,
    is_random). Of each label, the ``MOST_SAMPLES`` distinct texts with the smallest hash are used."""
    rows = samples.select(quoted(text_col).alias("t"), quoted(random_col).alias("r"))
    rows = rows.filter(F.col("t").rlike(r"^[\x21-\x7E]{2,}$") & F.col("r").isNotNull())
    counts = np.ones((2, 128 * 128))
    for label in (False, True):
        mine = rows.filter(F.col("r") == label).select("t").distinct()
        mine = mine.orderBy(F.xxhash64("t"), "t").limit(MOST_SAMPLES)
        found = mine.select(F.explode(F.expr(steps("t"))).alias("step")).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
        for row in found.collect():  # at most 128 x 128 rows
            counts[int(label), row.step] += row.n
    tables = counts.reshape(2, 128, 128)
    logs = np.log(tables / tables.sum(2, keepdims=True))
    return (logs[1] - logs[0]).ravel()


def scan(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(row, spans): ``row`` holds the columns of ``docs`` but the text; spans are (start, kind, end), kind
    as a place in ``KINDS``, by start, then kind."""
    rest = [quoted(c) for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*rest).alias("row"), whole_text(text_col).alias("text"))
    rows = add_spans(base_spans(rows), "token", TOKEN).drop("text")
    weights = "cast(split('" + ",".join(f"{x:.6f}" for x in ratios) + "', ',') AS array<double>)"
    mean = f"aggregate({steps('s.value')}, 0D, (a, k) -> a + {weights}[k]) / (char_length(s.value) - 1)"
    told = " OR ".join(
        [
            f"s.value rlike {literal(f'{ACCESS}|{HEX}')}",
            f"s.value rlike {literal(f'^{ASSIGN_HEAD}')}",
            f"s.before rlike {literal(f'{ASSIGN_HEAD}$')}",
        ]
    )
    rows = rows.withColumn("random", F.expr(f"filter(token, s -> NOT ({told}) AND {mean} >= {threshold}D)"))
    tagged = [F.expr(f"transform({k}, s -> struct(s.start AS start, {i} AS kind, s.end AS end))") for i, k in enumerate(KINDS)]
    return rows.select("row", F.array_sort(F.concat(*tagged)).alias("spans"))


def labelled_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 5_000) -> DataFrame:
    """Labelled samples (text, is_random) for ``fit``, from ``sample`` documents, those with the smallest
    hash of the id: what the base patterns find is random; words with no digit are ordinary."""
    chosen = docs.select(quoted(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(quoted(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id", "left_semi")
    spans = base_spans(rows)
    value = f"regexp_extract(s.value, {literal(f'({ASSIGN_VALUE})$')}, 1)"
    found = spans.select(F.explode(F.expr(f"concat(transform(assign, s -> {value}), access.value, hex.value)")).alias("text"))
    words = rows.select(F.explode(F.expr(r"regexp_extract_all(text, '[A-Za-z_-]{4,}', 0)")).alias("text"))
    return found.withColumn("is_random", F.lit(True)).union(words.withColumn("is_random", F.lit(False)))
