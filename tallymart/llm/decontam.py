"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are runs of characters other than ASCII signs, blanks and controls, with A-Z as a-z. A window is
``window`` consecutive words of an item; an item of fewer words is one window. A document word is hit if
it lies in any occurrence of a window.

Hashes of word k-grams slide over a text; a k-gram is a fingerprint if its hash is the least of some
w = window - k + 1 neighbouring ones, so every shared span of a window's length has a shared fingerprint
at the same place in it. Only fingerprints are joined. Documents that share one are looked at again: wherever
the shared hash stands, the window's words are compared with the document's words around it, so results
do not rest on hashes. Items shorter than
the window are handled alike, once for each of the few lengths that occur.

The item side is broadcast if its counted rows are few, else both sides are shuffled. Rows of one id and
one text are one document. Null and empty texts have no words and no hit. Every item counts, whatever
the number of items or documents that share a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import broadcast_if_small, same, stored, whole_text

GRAM = 5  # words of a fingerprint
# Fixed value: what separates words, after A-Z became a-z.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    # Both give the same for ASCII texts, where the first is much faster.
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, GAPS), "")


def running(frame: DataFrame, name: str, w: int, merged: str) -> DataFrame:
    """Turn the array ``name`` into what ``merged``, SQL of a and b, makes of each ``w`` neighbouring values,
    by runs of 1, 2, 4, ... of them; the last two runs may overlap."""
    frame = frame.withColumn("__size", F.expr(f"greatest(size({name}) - {w - 1}, 0)"))
    reach = 1
    while reach < w:
        step = min(reach, w - reach)
        shifted = f"slice({name}, {step + 1}, size({name}))"
        frame = frame.withColumn(name, F.expr(f"zip_with({name}, {shifted}, (a, b) -> {merged})"))
        reach += step
    return frame.withColumn(name, F.expr(f"slice({name}, 1, __size)")).drop("__size")


def _windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words, len): each distinct window of each item."""
    words = items.select(quoted(id_col).cast("string").alias("item"), words_of(whole_text(text_col)).alias("all"))
    words = words.filter(F.size("all") > 0).withColumn("len", F.least(F.size("all"), F.lit(window)))
    starts = F.explode(F.expr("sequence(1, size(all) - len + 1)")).alias("start")
    cut = words.select("item", "all", "len", starts).select("item", F.expr("slice(all, start, len)").alias("words"), "len")
    return cut.distinct()


def _hashed(frame: DataFrame, length: int) -> DataFrame:
    """Add ``h``, the k-gram hashes of ``words``."""
    frame = frame.withColumn("h", F.expr("transform(words, x -> xxhash64(x))"))
    return running(frame, "h", min(GRAM, length), "xxhash64(a, b)")


def document_fingerprints(docs: DataFrame, length: int) -> DataFrame:
    """(doc, mixed, hash) of a table with doc, mixed, words: the least k-gram hash of each window, each once."""
    picked = _hashed(docs, length).select("doc", "mixed", F.col("h").alias("least"))
    picked = running(picked, "least", length - min(GRAM, length) + 1, "least(a, b)")
    return picked.select("doc", "mixed", F.explode(F.array_distinct("least")).alias("hash"))


def window_fingerprints(windows: DataFrame, length: int) -> DataFrame:
    """Add (hash, offset) of the fingerprint of each window, the first if several are least."""
    one = _hashed(windows.filter(F.col("len") == length), length)
    one = one.withColumn("hash", F.array_min("h"))
    return one.withColumn("offset", F.array_position("h", F.col("hash")) - 1).drop("h")


def _places(texts: DataFrame, found: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """(doc, mixed, start, wanted): where the windows of shared fingerprints would begin in the documents."""
    each = found.groupBy(F.col("doc").alias("d"), F.col("mixed").alias("m")).agg(F.collect_set("hash").alias("shared"))
    each = broadcast_if_small(stored(each, "shared"))
    hit = texts.join(each, same(F.col("doc"), F.col("d")) & (F.col("mixed") == F.col("m")))
    hit = _hashed(hit.select("doc", "mixed", words_of(F.col("text")).alias("words"), "shared"), length)
    at = F.expr("filter(transform(h, (x, i) -> if(array_contains(shared, x), struct(i AS at, x AS hash), null)), p -> p IS NOT NULL)")
    at = hit.select("doc", "mixed", F.explode(at).alias("p")).select("doc", "mixed", "p.at", "p.hash")
    at = at.join(marks, "hash")
    return at.select("doc", "mixed", (F.col("at") - F.col("offset")).alias("start"), F.col("words").alias("wanted"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    only_shared: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, mixed (hash of the text), n_words, n_hit, hit (positions of hit
    words, from 0), item_ids (those with occurring windows, as sorted strings). With ``only_shared``,
    documents that share no fingerprint with an item, and so have no hit, are left out."""
    spark = docs.sparkSession
    texts = docs.select(
        quoted(id_col).alias("doc"), F.xxhash64(whole_text(text_col)).alias("mixed"), whole_text(text_col).alias("text")
    )
    item_windows = stored(_windows(items, item_col, item_text_col, window), "item-windows")
    distinct = stored(
        item_windows.select("words", "len", F.xxhash64("words").alias("code")).distinct(), "windows"
    )
    lengths = sorted(r.len for r in distinct.select("len").distinct().collect())  # at most ``window`` numbers
    worded = texts.select("doc", "mixed", words_of(F.col("text")).alias("words"))
    hits = []
    for length in lengths:
        marks = stored(window_fingerprints(distinct, length).drop("code"), "marks")
        marks = broadcast_if_small(marks)
        codes = marks.select("hash").distinct()
        codes = broadcast_if_small(codes, 64)
        found = document_fingerprints(worded, length).join(codes, "hash", "left_semi")
        hits.append(_places(texts, found, marks, length))
    if hits:
        found = reduce(DataFrame.union, hits).filter("start >= 0")
    else:
        none = "doc {}, mixed bigint, start int, wanted array<string>".format(texts.schema["doc"].dataType.simpleString())
        found = spark.createDataFrame([], none)
    # Fingerprints that lie side by side point to the same place; each place counts once.
    places = found.groupBy("doc", "mixed").agg(F.collect_set(F.struct("start", "wanted")).alias("places"))
    places = stored(places, "places")
    few = broadcast_if_small(places.select(F.col("doc").alias("d"), F.col("mixed").alias("m"), "places"))
    joined = texts.join(few, same(F.col("doc"), F.col("d")) & (F.col("mixed") == F.col("m")), "inner" if only_shared else "left")
    joined = joined.select("doc", "mixed", words_of(F.col("text")).alias("words"), "places")
    real = F.expr("filter(places, p -> slice(words, p.start + 1, size(p.wanted)) = p.wanted)")
    checked = joined.withColumn("real", F.coalesce(real, F.expr("cast(array() as array<struct<start:int,wanted:array<string>>>)")))
    hit = "array_sort(array_distinct(flatten(transform(real, p -> sequence(p.start, p.start + size(p.wanted) - 1)))))"
    checked = checked.select(
        "doc",
        "mixed",
        F.size("words").cast("bigint").alias("n_words"),
        F.expr(hit).alias("hit"),
        F.expr("array_distinct(transform(real, p -> p.wanted))").alias("wanted"),
    )
    checked = stored(checked, "checked")
    with_items = checked.filter(F.size("wanted") > 0).select("doc", "mixed", F.explode("wanted").alias("words")).distinct()
    with_items = with_items.join(item_windows.select("words", "item"), "words").select("doc", "mixed", "item").distinct()
    named = with_items.groupBy(F.col("doc").alias("d"), F.col("mixed").alias("m")).agg(
        F.sort_array(F.collect_list("item")).alias("item_ids")
    )
    out = checked.join(named, same(F.col("doc"), F.col("d")) & (F.col("mixed") == F.col("m")), "left")
    return out.select(
        F.col("doc").alias(id_col),
        "mixed",
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        "hit",
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    bad = contamination(docs, items, id_col, text_col, only_shared=True, **options).filter("n_hit > 0")
    bad = stored(bad.select(F.col(id_col).alias("__bad"), F.col("mixed").alias("__mixed")).distinct(), "contaminated")
    match = same(quoted(id_col), F.col("__bad")) & (F.xxhash64(whole_text(text_col)) == F.col("__mixed"))
    return docs.join(broadcast_if_small(bad, 64), match, "left_anti")
