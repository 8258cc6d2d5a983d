"""The numbered queries: each applies one operator to its whole table and returns digests of its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, chat, decontam, exact, filteraudit, langid, lines, lm, merkle, minhash, secrets, setjoin, warc
from .shared import crc_remainder, read_table
from .sql import SQL


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = crc_remainder("doc_id", 3) == 1
    model = langid.fit(docs.filter(~held_out).select("lang", "text"))
    found = langid.label_spans(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "spans")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    windows = chat.format_windows(turns.unionByName(made))
    read = chat.read_turns(windows)
    # The digest is over a whole conversation, so its turns come together here, and only here.
    one = F.struct(
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"),
        F.size("turns").alias("n"),
        "length",
    )
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("all"))
    targets = F.array_join(F.transform("all", lambda w: w["targets"]), "")
    return whole.select(
        "conv_id",
        F.aggregate("all", F.lit(0).cast("bigint"), lambda s, w: s + w["n"]).alias("n_turns"),
        F.sha2(F.array_join(F.transform("all", lambda w: w["turns"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(targets).cast("bigint").alias("loss_chars"),
        F.sha2(targets.cast("binary"), 256).alias("loss_sha256"),
        F.aggregate("all", F.lit(0).cast("bigint"), lambda s, w: s + w["length"]).alias("formatted_chars"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = secrets.fit(secrets.labelled_tokens(docs))
    found = secrets.scan(docs, ratios)
    names = F.array(*[F.lit(k) for k in secrets.KINDS])

    def shown(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "row.doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])],
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.drop_repeated_lines(docs)
    kept = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256)
    return found.select("row.doc_id", "n_lines", "n_kept", kept.alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode(docs, bpe.read_vocabulary(vocabulary or public_vocabulary()), with_decoded=True)
    ids = F.array_join(F.col("ids").cast(T.ArrayType(T.StringType())), " ")
    return found.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_groups(docs, words=2, percent=80)


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, crc_remainder("doc_id", 7) == 2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontam.contamination(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = warc.resolve_revisits(warc.records_of_pages(pages))
    shown = F.array_join(
        F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )
    return found.select(
        "record_id",
        "canonical_url",
        "outcome",
        "source_id",
        shown.alias("headers"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"),
    )


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_groups(docs, keep="max")


def op11_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return setjoin.similar_groups(docs, words=5, percent=80)


def op12_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labels = read_table(spark, sf_dir, "labels")
    return filteraudit.audit_documents(docs, labels, filteraudit.text_conditions(), copies="E")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*MANIFEST_FIELDS)
    changed = F.col("doc_id").isNotNull() & (crc_remainder("doc_id", 7) == 0)
    n_chars = F.col("n_chars") + F.when(changed, 1).otherwise(0)
    tampered = merkle.field_digest([n_chars if c == "n_chars" else F.col(c) for c in MANIFEST_FIELDS])
    found = merkle.manifest(docs, MANIFEST_FIELDS, "lang", "doc_id", {"tampered": tampered})
    found = found.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("witness")))
    proof = merkle.siblings(F.col("witness")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language, op2_chat, op3_secrets, op4_lines, op5_bpe, op6_minhash, op7_lm, op8_decontamination, op9_warc,
        op10_exact, op11_setjoin, op12_filteraudit, op13_merkle, pipeline,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
