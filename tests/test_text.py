from __future__ import annotations

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightwater.functions import extraction, spans, text as tx
from brightwater.operators import classify, documents

CONTRACT = (
    "Hallam Industries Company must refund OrrinCorp €12,750 before March 3, 2026. "
    "Samples shall travel back within 14 days. "
    "OrrinCorp requires a receipt."
)


def apply(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1)
    return [r.out for r in df.select("i", column(F.col("text")).alias("out")).orderBy("i").collect()]


CLEANED = [
    ("<p>Two  <i>words</i></p>", "Two words"),
    ("ask desk.two+x@mail-host.net, or ftp", "ask [EMAIL], or ftp"),
    ("see http://a.b/c?d=1#e then www.f.org!", "see [URL] then [URL]"),
    ("HTTPS is not lower: HTTP://UPPER.example", "HTTPS is not lower: HTTP://UPPER.example"),
    ("x\u00a0y\u2028z \x1c \x1f w", "x y z w"),
    ("\ufb01ne \u2460 \uff21", "fine 1 A"),
    ("a<b>in</b>side <open", "a in side <open"),
    ("no@dot a@b.c1 a@b.com1", "no@dot a@b.c1 a@b.com1"),
    ("", ""),
    (" \n\t ", ""),
]


def test_cleaning(spark):
    assert apply(spark, tx.clean_text, *[t for t, _ in CLEANED]) == [want for _, want in CLEANED]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1é@._+- <>/:wht\t \x1d", max_size=25), min_size=1, max_size=20))
def test_clean_text_has_single_spaces_and_no_tags(spark, texts):
    for out in apply(spark, tx.clean_text, *texts):
        assert out == " ".join(out.split()) and not re.search("<[^>]+>", out)


def test_clean_options(spark):
    kept = apply(spark, lambda c: tx.clean_text(c, remove_emails=False, remove_urls=False, lowercase=True), "A@b.com www.X.org")
    assert kept == ["a@b.com www.x.org"]


def test_null_text_stays_null(spark):
    assert apply(spark, tx.clean_text, None) == [None]


def test_sentences_read_the_whole_text(spark):
    long = "Word here. " * 1000 + "Last one!"
    found = apply(spark, tx.sentences, long, "One. Two?  Three\n", "")
    assert len(found[0]) == 1001 and found[0][-1] == "Last one!"
    assert found[1:] == [["One.", "Two?", "Three"], []]
    short = apply(spark, lambda c: tx.sentences(c, tx.ENCODER_CHARS), long)
    assert len(short[0]) == 187


def test_tokens(spark):
    assert apply(spark, tx.tokens, "The cat, the Cat!") == [["cat", "cat"]]
    assert apply(spark, lambda c: tx.tokens(c, None), "The cat's Éclair") == [["the", "cat", "s", "éclair"]]


def test_lemmas_replace_listed_forms(spark):
    docs = spark.createDataFrame([(1, "Parties agreed quickly")], "doc_id int, text string")
    lemmas = spark.createDataFrame([("parties", "party"), ("agreed", "agree")], "form string, lemma string")
    rows = documents.token_rows(docs, lemmas=lemmas).orderBy("position").collect()
    assert [r.token for r in rows] == ["party", "agree", "quickly"]


def test_truncation_keeps_393_words(spark):
    out = apply(spark, tx.truncate_words, "word " * 1000, " a  b ")
    assert len(out[0].split()) == 393 and out[1] == "a b"


def test_softmax_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "x array<double>")
    assert df.select(tx.softmax(F.col("x")).alias("p")).head().p == [0.5, 0.5, 0.0]


def test_contract_extraction(spark):
    docs = spark.createDataFrame([("c", CONTRACT), ("plain", "Rain fell on the harbour.")], "doc_id string, text string")
    out = {r.doc_id: r for r in documents.extraction_result(docs).collect()}
    found = out["c"]
    assert found.parties == ["Hallam Industries Company", "OrrinCorp", "OrrinCorp"]
    assert found.monetary_values == ["€12,750"]
    assert found.dates == ["March 3, 2026", "14 days"]
    assert found.obligations == re.split(r"(?<=\.) ", CONTRACT)
    assert found.entity_count == len(found.entities) == 6
    assert out["plain"].obligations == [] and out["plain"].entity_count == 0


def test_obligation_words_match_whole_tokens_only(spark):
    texts = ["He shall pay.", "Marshall paid.", "They REQUIRE it.", "Goodwill only.", "x" * 5000 + ". You must."]
    found = apply(spark, extraction.extract_obligations, *texts)
    assert [len(f) for f in found] == [1, 0, 1, 0, 1]


def test_entity_offsets_point_into_the_text(spark):
    docs = spark.createDataFrame([(1, CONTRACT), (2, None), (3, "Été: paid $3.5 million on 2024-05-06")], "doc_id int, text string")
    rows = documents.entity_table(docs).collect()
    texts = {1: CONTRACT, 3: "Été: paid $3.5 million on 2024-05-06"}
    assert all(texts[r.doc_id][r.start : r.end] == r.text and r.confidence == 1.0 for r in rows)
    assert [(r.text, r.label) for r in rows if r.doc_id == 3] == [("$3.5 million", "MONEY"), ("2024-05-06", "DATE")]
    listed = documents.extraction_result(docs.filter("doc_id = 1"), normalize=False).head().entities
    assert [(e.text, e.label) for e in listed] == [(r.text, r.label) for r in rows if r.doc_id == 1]


def test_batch_fills_missing_ids_and_drops_nothing(spark):
    docs = spark.createDataFrame([("d1", "Orrin shall pay."), (None, "b"), ("d3", None)], "doc_id string, text string")
    ids = sorted(r.doc_id for r in documents.extract_batch(docs.coalesce(1)).collect())
    assert ids == ["d1", "d3", "doc_1"]
    many = spark.range(1000, numPartitions=7).select(F.col("id").cast("string").alias("text"))
    numbered = documents.with_document_ids(many).collect()
    assert all(r.doc_id == f"doc_{r.text}" for r in numbered)


def test_gazetteer_finds_phrases_of_any_listed_length(spark):
    docs = spark.createDataFrame([(1, "From New York to York, NEW  york!"), (2, "")], "doc_id int, text string")
    names = spark.createDataFrame([("new york", "GPE"), ("York", "GPE"), ("york", "ORG")], "phrase string, label string")
    rows = documents.gazetteer_entities(docs, names).collect()
    assert sorted((r.text, r.label, r.token_index) for r in rows) == [
        ("new york", "GPE", 1),
        ("new york", "GPE", 5),
        ("york", "GPE", 2),
        ("york", "GPE", 4),
        ("york", "GPE", 6),
        ("york", "ORG", 2),
        ("york", "ORG", 4),
        ("york", "ORG", 6),
    ]


def test_compliance_flags(spark):
    docs = spark.createDataFrame([(1, CONTRACT), (2, "write to a@b.com or www.x.org")], "doc_id int, text string")
    one, two = documents.compliance_flags(docs).orderBy("doc_id").collect()
    assert (one.has_obligation, one.has_money, one.has_date, one.has_email, one.needs_review) == (True, True, True, False, True)
    assert (two.has_obligation, two.has_email, two.has_url, two.needs_review) == (False, True, True, False)


def test_review_is_decided_on_unrounded_confidence(spark):
    df = spark.createDataFrame([("text " * 50, [0.74996, 0.25004])], "clean string, s array<double>")
    row = classify.label_scores(df, F.col("s"), ["legal", "other"]).head()
    assert (row.label, row.confidence, row.requires_review) == ("legal", 0.75, True)
    assert row.all_scores == {"legal": 0.75, "other": 0.25} and len(row.text_snippet) == 120


def test_classifier_learns_five_labels(spark):
    words = {"compliance": "audit policy", "legal": "court clause", "financial": "invoice bank", "operational": "shift plant", "other": "cat garden"}
    rows = [(i, f"{w} {w} number {i % 3}", label) for label, w in words.items() for i in range(6)]
    docs = spark.createDataFrame([(f"{label}{i}", t, label) for i, t, label in rows], "doc_id string, text string, category string")
    model = classify.train_classifier(docs, "category", num_features=256, max_iter=20)
    assert classify.model_labels(model) == sorted(classify.LABELS)
    out = classify.classify_documents(docs, model)
    scored = out.join(docs.select("doc_id", "category"), "doc_id").collect()
    assert all(r.label == r.category for r in scored)
    assert all(sum(r.all_scores.values()) == pytest.approx(1, abs=1e-3) for r in scored)
    auto, review = classify.auto_triage(out)
    assert auto.count() + review.count() == len(rows)


def test_classifying_with_another_model(spark):
    docs = spark.createDataFrame([(1, "<b>Court</b> order"), (2, "cats")], "doc_id int, text string")

    def score(df):
        return df.withColumn("scores", tx.softmax(F.array(F.size("words") * 1.0, F.lit(1.5))))

    out = {r.doc_id: r for r in classify.classify_with(docs, score, ["legal", "other"]).collect()}
    assert (out[1].label, out[2].label, out[1].text_snippet) == ("legal", "other", "Court order")
    assert all(r.requires_review for r in out.values())


def test_automation_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "requires_review boolean")
    assert classify.automation_rate(empty).head().automation_rate is None


def brute_spans(text):
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W]+", text)]


def test_token_spans_of_long_and_odd_texts(spark):
    texts = ["", "one", " Été,  NEW\tyork! ", "w " * 700 + "end", "...", "x" * 5000 + " 😀 y"]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    found = [r.s for r in frame.select(spans.token_spans(F.col("t")).alias("s")).collect()]
    assert found[-1] is None
    for text, got in zip(texts, found):
        assert [(s.text, s.start, s.end) for s in got] == brute_spans(text)
        assert "".join(s.gap + s.text for s in got) == text[: got[-1].end if got else 0]


def swept(found):
    out, free = [], 0
    for s in sorted(found, key=lambda s: (s[0], -s[1], s[2], s[3])):
        if s[0] >= free:
            out.append(s)
            free = s[1]
    return out


def test_sweep_keeps_the_leftmost_longest(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(60):
        starts = [rng.randrange(30) for _ in range(rng.randrange(12))]
        rows.append(([(a, a + rng.randint(1, 9), rng.randrange(2), rng.choice("AB")) for a in starts],))
    frame = spark.createDataFrame(rows, "f array<struct<start:int,end:int,rank:int,label:string>>")
    for r in frame.select("f", spans.leftmost_longest(F.col("f")).alias("k")).collect():
        assert [tuple(s) for s in r.k] == swept([tuple(s) for s in r.f])


def test_list_and_patterns_resolve_into_entities_without_overlap(spark):
    names = spark.createDataFrame(
        [("Ann  Lee", "PERSON"), ("Hallam", "GPE"), ("Lee Road Act", "LAW"), ("march", "EVENT"), ("road act", "LAW"), ("", "GPE")], "phrase string, label string"
    )
    text = "Ann\tLee of Hallam and Hallam Industries Company signed the Lee  road ACT on March 3, 2026. Ann Lee Road Act!"
    rows = [(1, text), (None, "ann lee"), (None, "Hallam"), (3, None), (4, "nothing here"), (5, text), (5, text)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = documents.entity_table(docs, gazetteer=names).collect()
    want = [
        ("Ann\tLee", "PERSON"), ("Hallam", "GPE"), ("Hallam Industries Company", "ORG"), ("Lee  road ACT", "LAW"),
        ("March 3, 2026", "DATE"), ("Ann Lee", "PERSON"), ("Road Act", "LAW"),
    ]
    first = sorted((r.start, r.text, r.label, r.end) for r in found if r.doc_id == 1)
    assert [(t, label) for _, t, label, _ in first] == want and all(text[s:e] == t for s, t, _, e in first)
    assert sorted((r.text, r.label) for r in found if r.doc_id is None) == [("Hallam", "GPE"), ("ann lee", "PERSON")]
    assert sum(r.doc_id == 5 for r in found) == len(want)  # rows that repeat id and text have one result
    out = documents.extraction_result(docs, normalize=False, gazetteer=names).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out if r.doc_id}
    assert by_id[1].parties == by_id[5].parties == ["Ann Lee", "Hallam Industries Company", "Ann Lee"]
    assert (by_id[1].entity_count, by_id[4].entity_count, by_id[4].entities) == (7, 0, []) and by_id[3].entities is None


def test_trie_of_nothing_finds_nothing(spark):
    docs = spark.createDataFrame([(1, "From New York")], "doc_id int, text string")
    assert documents.gazetteer_entities(docs, spark.createDataFrame([], "phrase string, label string")).collect() == []


def test_few_partitions_of_short_texts_are_spread(spark):
    docs = spark.createDataFrame([(i, "Ann Lee of Hallam") for i in range(400)], "doc_id int, text string").coalesce(1)
    names = spark.createDataFrame([("Ann Lee", "PERSON"), ("ann lee", "LAW"), ("Hallam", "GPE")], "phrase string, label string")
    made = documents.gazetteer_entities(docs, names)
    found = made.groupBy("text", "label").agg(F.count("*").alias("n"), F.min("start").alias("s"), F.max("end").alias("e")).collect()
    assert {(r.text, r.label, r.n, r.s, r.e) for r in found} == {
        ("ann lee", "PERSON", 400, 0, 7), ("ann lee", "LAW", 400, 0, 7), ("hallam", "GPE", 400, 11, 17),
    }
    tokens = documents.spread(docs).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tokens >= spark.sparkContext.defaultParallelism
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan


def test_nfkd_over_many_slices_keeps_nulls_and_order(spark):
    import unicodedata

    texts = [None if i % 7 == 0 else "Été ﬁn" if i % 300 == 5 else f"plain {i}" for i in range(1500)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = {r.i: r.n for r in frame.select("i", tx.normalize_nfkd(F.col("t")).alias("n")).collect()}
    assert got == {i: None if t is None else unicodedata.normalize("NFKD", t) for i, t in enumerate(texts)}


def test_classifier_keeps_counts_not_words(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    seen, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: (seen.append(self.columns), persist(self, *a))[1])
    rows = [(i, "good apple pie" if i % 2 else "bad engine oil", "food" if i % 2 else "cars") for i in range(40)]
    model = classify.train_classifier(spark.createDataFrame(rows, "doc_id int, text string, kind string"), "kind", normalize=False)
    assert seen == [["category", "tf"]] and classify.model_labels(model) == ["cars", "food"]
    out = classify.classify_documents(spark.createDataFrame(rows, "doc_id int, text string, kind string"), model, normalize=False)
    assert {(r.doc_id % 2, r.label) for r in out.collect()} == {(0, "cars"), (1, "food")}
