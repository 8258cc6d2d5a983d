"""From raw documents to token ids: language, exact copies, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``. All but the last return the columns of documents. Null and empty texts have
no language and go in the first stage, as do jumbles of languages; ids may be null or repeated (see each operator).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import bpe, decontam, exact, langid, minhash
from tallymart.llm.queries import public_vocabulary
from tallymart.llm.shared import read_table, stored

# The last stage tells rows apart by their place and adds token ids, so SQL cannot express it.
ORACLE_SQL = None

# The least share of a main language: no document of 256,410 on check_l, whose mixed texts are wanted, is below it.
MAIN_SHARE = 0.3


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language: one that holds ``MAIN_SHARE`` of the letters or more, by the spans. Those
    without a letter go. The model learns from every labelled row; without any the stage can tell nothing and stops."""
    model = langid.fit(docs.select("lang", "text"))
    if not model.langs and not docs.filter(F.col("text").rlike(r"\p{L}")).isEmpty():
        raise ValueError("no document with a letter has a lang, so languages cannot be learned")
    found = langid.label_spans(docs, model, with_text=True)
    found = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MAIN_SHARE))
    return found.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest id."""
    return exact.drop_copies(docs, keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: runs of five words, similarity 0.8 or more."""
    return minhash.drop_near_copies(docs, words=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item, and no whole item of fewer than ten: with an
    item of one or two words, every document that holds these goes."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the ids of each text's tokens and their number; these take the place of columns
    that were called so."""
    docs = docs.drop("token_ids", "n_tokens")
    found = bpe.encode(docs, bpe.read_vocabulary(public_vocabulary()), with_text=True)
    return found.select("row.*", F.col("ids").alias("token_ids"), F.size("ids").cast("bigint").alias("n_tokens"))


# Rows of a batch that goes to Python and back. Texts are long: of Spark's 10,000 rows a task would hold some
# hundred megabytes beside its work.
BATCH_ROWS = "1000"


def small_batches(stage):
    """``stage``, with batches of ``BATCH_ROWS`` from now on, unless the session has set another number."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if spark.conf.get(name) == "10000":
            spark.conf.set(name, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", small_batches(languages)),
    ("exact_dedup", small_batches(exact_copies)),
    ("near_dedup", small_batches(near_copies)),
    ("decontamination", small_batches(benchmark_passages)),
    ("bpe", small_batches(token_ids)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
