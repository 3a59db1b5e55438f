"""Registered queries with SQL against DuckDB, the others against brute force, and the pipeline."""

from __future__ import annotations

import hashlib

import pytest
import tiktoken
from compare import differences, duck
from pyspark.sql import functions as F

import corpus_pipeline
from brightwater.llm import bpe
from brightwater.llm.queries import ORACLES, QUERIES


def rows(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert differences(spark, duck(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == []


def test_op3_base_spans(spark, sf_dir):
    from test_llm_small import base_spans

    texts = {r.doc_id: r.text for r in rows(spark, sf_dir, "documents")}
    found = {r.doc_id: r for r in QUERIES["op3_secrets"](spark, sf_dir).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        spans = base_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert found[i].n_assign == sum(s.startswith("assign") for s in spans)
        assert set(spans) <= set(found[i].spans.split(","))  if spans else True


def test_op4_gives_the_article(spark, sf_dir):
    import re
    from html import unescape

    found = {r.page_id: r for r in QUERIES["op4_html"](spark, sf_dir).collect()}
    for page in rows(spark, sf_dir, "pages"):
        article = page.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [re.sub(r"\s+", " ", unescape(re.sub("<[^>]+>", "", p))).strip() for p in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(p for p in parts if p)
        assert (found[page.page_id].text, found[page.page_id].n_chars) == (want, len(want))


def test_op5_equals_the_library(spark, sf_dir):
    ranks, pattern = bpe.multilingual()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, sf_dir).collect()}
    for doc in rows(spark, sf_dir, "documents"):
        ids = library.encode_ordinary(doc.text or "")
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


def test_op7_tells_held_out_documents_apart(spark):
    # Needs more labels than the smallest tables have.
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in rows(spark, sf_dir, "labels")}
    held = [r for r in QUERIES["op7_quality"](spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held)


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, last = docs.columns, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() > 0
        if k < 4:
            assert docs.columns == columns
        if k == 1:
            assert docs.select(F.expr("lower(text)")).distinct().count() == docs.count()
        last = docs
    ranks, _ = bpe.multilingual()
    tokens = {i: t for t, i in ranks.items()}
    for row in last.collect():
        assert b"".join(tokens[i] for i in row.ids) == row.text.encode() and row.n_tokens == len(row.ids)


def test_pipeline_keeps_odd_rows(spark, tmp_path):
    texts = [(None, "a quiet text " * 9, "s"), (1, None, None), (2, "", "s"), (3, "Another text, quite clean.", "s"), (3, "Another text, quite clean.", "s")]
    schema = "doc_id long, text string, source string"
    spark.createDataFrame(texts, schema).select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {None, 3}
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_pipeline_tells_nameless_texts_apart_by_case_beyond_a_to_z(spark):
    texts = [(None, "\u00c9TUDE a"), (None, "\u00e9tude a"), (None, "\u00c9tude A"), (4, "x")]
    out = corpus_pipeline.without_copies(spark, spark.createDataFrame(texts, "doc_id long, text string"), "").collect()
    assert sorted(r.text.replace("A", "a").replace("TUDE", "tude") for r in out) == ["x", "\u00c9tude a", "\u00e9tude a"]


def test_stages_pass_columns_of_any_name_on(spark):
    texts = [(1, "a b c", "s"), (2, "A b c", "s"), (2, "a B c", "s"), (None, "x y", None)]
    frame = spark.createDataFrame([(*t, 5, "t", "d", "o") for t in texts], "doc_id long, text string, source string, epoch int, _text string, _digest string, _order string")
    once = corpus_pipeline.without_copies(spark, frame, "")
    assert sorted((str(r.doc_id), r.epoch, r._text, r._digest, r._order) for r in once.collect()) == [("2", 5, "t", "d", "o"), ("None", 5, "t", "d", "o")]
    mixed = corpus_pipeline.mixed(spark, frame, "")
    assert mixed.columns == frame.columns and {r.epoch for r in mixed.collect()} == {5}


def test_encoding_takes_one_python_worker_a_core(spark):
    frame = spark.createDataFrame([(1, "Ein Satz.", "de", "a", 9), (2, None, "de", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.encoded(spark, frame, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.text, r.n_tokens > 0) for r in out.collect()) == [(1, "Ein Satz.", True), (2, "", False)]
