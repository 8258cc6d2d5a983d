"""The corpus pipeline against plain Python, and its stages on awkward rows."""

import unicodedata

import corpus_pipeline
import pytest
from conftest import TESTDATA
from test_llm_small import HARD, brute_contamination, brute_groups, tokenizer


def brute_pipeline(rows, items):
    """(doc_id, text, token ids) that the stages leave of (doc_id, text)."""
    rows = [(d, t) for d, t in rows if any(unicodedata.category(c)[0] == "L" for c in t or "")]
    last = {}
    for d, t in rows:
        last[t] = max(d, last.get(t, d))
    rows = sorted((d, t) for t, d in last.items())
    groups = {d: least for d, _, least in brute_groups(rows, 5)}
    rows = [(d, t) for d, t in rows if groups[d] == d]
    hit = {d for d, _, n, _ in brute_contamination(rows, items) if n}
    encode = tokenizer().encode
    return [(d, t, encode(t, add_special_tokens=False).ids) for d, t in rows if d not in hit]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = brute_pipeline([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    made = corpus_pipeline.run(spark, TESTDATA)
    assert made.columns == [*docs.columns, "token_ids", "n_tokens"]
    found = sorted(made.collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.text, r.token_ids) for r in found] == wanted
    assert all(r.n_tokens == len(r.token_ids) for r in found)
    assert 0 < len(wanted) < docs.count()


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [(i, t, s, 7, "x", "old") for i, t, s in HARD]
    ddl = "doc_id bigint, text string, lang string, row int, `rest.of` string, token_ids string"
    docs = spark.createDataFrame(rows, ddl)
    kept = {"language": 6, "exact_dedup": 5, "near_dedup": 4, "decontamination": 4, "bpe": 4}
    empty, columns = docs.limit(0), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        for label, given, n in (("rows", docs, kept[name]), ("empty", empty, 0)):
            path = str(tmp_path / f"{name}-{label}")
            stage(spark, given, TESTDATA).write.parquet(path)
            made = spark.read.parquet(path)
            assert made.count() == n, (name, label)
            if name == "bpe":
                assert sorted(made.columns) == sorted([*columns, "n_tokens"])
                assert dict(made.dtypes)["token_ids"] == "array<int>"
            else:
                assert made.columns == columns
            if label == "rows":
                docs = made
            else:
                empty = made


def test_language_stage_rests_on_the_languages_found(spark):
    rows = [("a plain text", "en"), ("простой текст", "ru"), ("απλό κείμενο", "el"), ("שלום לכם", "he"), ("plain слова απλάα שלוםם", None), ("a plain text текст", None), ("12", "en")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.languages(spark, docs, TESTDATA).collect()}
    assert kept == {0, 1, 2, 3, 5}
    unlabelled = docs.withColumn("lang", docs.lang.substr(9, 1)).filter("lang = 'x'")
    assert corpus_pipeline.languages(spark, unlabelled, TESTDATA).count() == 0
    with pytest.raises(ValueError):
        corpus_pipeline.languages(spark, docs.selectExpr("doc_id", "text", "string(null) AS lang"), TESTDATA)
