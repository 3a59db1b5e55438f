"""Document text: cleaning, tokens, entities, classification, triage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.functions import extraction, text as tx
from brightwater.operators import abbreviations, classify, documents, tagger
from brightwater.operators.models import holdout_split
from brightwater.plans import sql
from brightwater.plans.registry import joined, query, rounded
from brightwater.session import written
from brightwater.sources.adapters import contract_texts, named_contracts, named_phrases, table


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# RE2, which DuckDB uses, has no lookaround: the trailing word edge is plain \b.
EMAIL_SQL = quoted(r"[\p{L}\p{N}_][\p{L}\p{N}_.+-]*@[\p{L}\p{N}_-]+\.[a-zA-Z\x{130}\x{131}\x{17f}\x{212a}]{2,}\b")
URL_SQL = quoted(tx.URL_PATTERN)
SPACES_SQL = quoted(f"{tx.SPACE}+")


def ws_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, {SPACES_SQL}, ' ', 'g'))"


def clean_sql(text: str) -> str:
    out = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    out = f"regexp_replace({out}, {EMAIL_SQL}, '[EMAIL]', 'g')"
    return ws_sql(f"regexp_replace({out}, {URL_SQL}, '[URL]', 'g')")


def sentences_sql(text: str) -> str:
    """A line break after each sentence end, then a split; the text holds no other line break."""
    marked = f"regexp_replace({text}, {quoted(f'([.!?]){tx.SPACE}+')}, '\\1' || chr(10), 'g')"
    return f"list_filter(string_split({marked}, chr(10)), lambda s: s <> '')"


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quoted(tx.TOKEN_PATTERN)})"


BOTH = """both_kinds AS (SELECT concat('page', CAST(page_id AS VARCHAR)) AS doc_id, html AS text FROM pages
          UNION ALL SELECT concat('doc', CAST(doc_id AS VARCHAR)), text FROM documents)"""


def pages_and_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    return pages.select(
        F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("doc_id"), F.col("html").alias("text")
    ).unionByName(docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("doc_id"), "text"))


@query("normalize_nfkd", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def normalize_nfkd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal form KD with its combining marks taken off, which SQL can say too."""
    plain = F.regexp_replace(tx.normalize_nfkd(F.col("text")), r"\p{M}", "")
    return table(spark, sf_dir, "documents").select("doc_id", plain.alias("text"))


@query("strip_html", "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages")
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_html(F.col("html")).alias("text"))


@query("redact_email", f"WITH {BOTH} SELECT doc_id, regexp_replace(text, {EMAIL_SQL}, '[EMAIL]', 'g') AS text FROM both_kinds")
def redact_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_and_documents(spark, sf_dir).select("doc_id", tx.redact_email(F.col("text")).alias("text"))


@query("redact_url", f"WITH {BOTH} SELECT doc_id, regexp_replace(text, {URL_SQL}, '[URL]', 'g') AS text FROM both_kinds")
def redact_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_and_documents(spark, sf_dir).select("doc_id", tx.redact_url(F.col("text")).alias("text"))


@query("normalize_ws", f"WITH {BOTH} SELECT doc_id, {ws_sql('text')} AS text FROM both_kinds")
def normalize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_and_documents(spark, sf_dir).select("doc_id", tx.normalize_ws(F.col("text")).alias("text"))


@query("clean_text", f"WITH {BOTH} SELECT doc_id, {clean_sql('text')} AS text FROM both_kinds")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without NFKD, which SQL lacks; ``clean_text_full`` has it."""
    return pages_and_documents(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text"), normalize=False).alias("text"))


@query("clean_text_full")
def clean_text_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_and_documents(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text"), lowercase=True).alias("text"))


@query(
    "sentencize",
    f"""WITH s AS (SELECT doc_id, {sentences_sql(ws_sql('text'))} AS parts FROM documents)
        SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS position, unnest(parts) AS sentence FROM s""",
)
def sentencize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", tx.normalize_ws(F.col("text")).alias("text"))
    return documents.sentence_rows(docs)


STOP_SQL = "[" + ", ".join(quoted(w) for w in tx.STOP_WORDS) + "]"


@query(
    "tokenize",
    f"""WITH t AS (SELECT doc_id, list_filter({tokens_sql('text')}, lambda w: NOT list_contains({STOP_SQL}, w)) AS parts
                   FROM documents)
        SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS position, unnest(parts) AS token FROM t""",
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.token_rows(table(spark, sf_dir, "documents"))


def word_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (form, lemma) table from the benchmark passages: a plural in -s is listed under its stem."""
    passages = table(spark, sf_dir, "benchmark")
    forms = passages.select(F.explode(tx.tokens(F.col("text"), None)).alias("form")).distinct()
    return forms.filter("form LIKE '%s' AND length(form) > 3").selectExpr("form", "substr(form, 1, length(form) - 1) AS lemma")


@query(
    "tokenize_lemmas",
    f"""WITH t AS (SELECT doc_id, list_filter({tokens_sql('text')}, lambda w: NOT list_contains({STOP_SQL}, w)) AS parts
                   FROM documents),
        rows_ AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS position, unnest(parts) AS token FROM t),
        forms AS (SELECT DISTINCT form FROM (SELECT unnest({tokens_sql('text')}) AS form FROM benchmark)
                  WHERE form LIKE '%s' AND length(form) > 3)
        SELECT doc_id, CAST(position AS INTEGER) AS position,
               CASE WHEN form IS NULL THEN token ELSE substr(form, 1, length(form) - 1) END AS token
        FROM rows_ LEFT JOIN forms ON token = form""",
)
def tokenize_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.token_rows(table(spark, sf_dir, "documents"), lemmas=word_forms(spark, sf_dir))


@query(
    "truncate_words",
    f"""SELECT doc_id, array_to_string(list_slice(list_filter(string_split({ws_sql('text')}, ' '), lambda w: w <> ''),
          1, 393), ' ') AS text FROM documents""",
)
def truncate_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.truncate_words(F.col("text")).alias("text"))


HELD_OUT = "CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), 1, 8)) AS BIGINT) % 10000 < 2000"
LABEL_CHECKS = "TRUE AS known_label, TRUE AS in_unit, TRUE AS review_fits"


def _split(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = holdout_split(docs, ["doc_id"])
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def _label_checks(labels: list[str]) -> list:
    """A label that was taught, a probability, and a review flag on its side of the threshold."""
    sure, limit = F.col("confidence"), classify.CONFIDENCE_THRESHOLD
    return [
        F.col("label").isin(labels).alias("known_label"),
        sure.between(0, 1).alias("in_unit"),
        F.when(F.col("requires_review"), sure <= limit).otherwise(sure >= limit).alias("review_fits"),
    ]


def _by_language(spark: SparkSession, sf_dir: str):
    """A classifier taught on the training side, with its labels, and the held-out documents."""
    train, test = _split(table(spark, sf_dir, "documents"))
    model = classify.train_classifier(train, "lang")
    return model, classify.model_labels(model), test


@query("classify_documents", f"SELECT doc_id, {LABEL_CHECKS} FROM documents WHERE {HELD_OUT}")
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out documents by language."""
    model, labels, test = _by_language(spark, sf_dir)
    out = classify.classify_documents(test, model)
    return out.select("doc_id", *_label_checks(labels))


@query("classify_quality", f"SELECT doc_id, {LABEL_CHECKS} FROM documents WHERE {HELD_OUT}")
def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the training side's documents with a quality label, applied to the held-out ones."""
    train, test = _split(table(spark, sf_dir, "documents"))
    model = classify.train_classifier(train.join(table(spark, sf_dir, "labels"), "doc_id"), "quality")
    return classify.classify_documents(test, model).select("doc_id", *_label_checks(classify.model_labels(model)))


@query(
    "score_map",
    f"""SELECT doc_id, label, TRUE AS in_unit, TRUE AS sums_to_one
        FROM documents, (SELECT DISTINCT lang AS label FROM documents WHERE NOT ({HELD_OUT})) WHERE {HELD_OUT}""",
)
def score_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of all scores opened into rows."""
    model, _, test = _by_language(spark, sf_dir)
    out = classify.classify_documents(test, model)
    total = F.aggregate(F.map_values("all_scores"), F.lit(0.0), lambda a, x: a + x)
    opened = out.select("doc_id", (F.abs(total - 1) < 1e-3).alias("sums_to_one"), F.explode("all_scores").alias("label", "score"))
    return opened.select("doc_id", "label", F.col("score").between(0, 1).alias("in_unit"), "sums_to_one")


@query(
    "softmax_scores",
    f"""WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS position
                   FROM embeddings),
        m AS (SELECT vec_id, max(x) AS top FROM e GROUP BY vec_id),
        p AS (SELECT vec_id, position, exp(x - top) AS w FROM e JOIN m USING (vec_id))
        SELECT vec_id, CAST(position AS INTEGER) AS position,
               {sql.r('w / sum(w) OVER (PARTITION BY vec_id)', 'score', 6)} FROM p""",
)
def softmax_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(tx.softmax(F.col("embedding"))).alias("position", "score")
    )
    return scored.withColumn("score", rounded("score", 6))


def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_discount") * 10).alias("confidence")
    )


@query(
    "auto_triage",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 10 AS confidence,
         l_discount * 10 < CAST(0.75 AS DOUBLE) AS requires_review,
         CASE WHEN l_discount * 10 < CAST(0.75 AS DOUBLE) THEN 'review' ELSE 'auto' END AS queue FROM lineitem""",
)
def auto_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.triage(confidences(spark, sf_dir))


@query(
    "automation_rate",
    """SELECT count(*) AS total, count(*) FILTER (WHERE l_discount * 10 >= CAST(0.75 AS DOUBLE)) AS auto_approved,
         count(*) FILTER (WHERE l_discount * 10 < CAST(0.75 AS DOUBLE)) AS needs_review,
         round(count(*) FILTER (WHERE l_discount * 10 >= CAST(0.75 AS DOUBLE)) / count(*), 6) AS automation_rate
       FROM lineitem""",
)
def automation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = classify.automation_rate(classify.triage(confidences(spark, sf_dir)))
    return rate.withColumn("automation_rate", F.round("automation_rate", 6))


def _matches_sql(pattern: str) -> str:
    return f"""WITH {sql.CONTRACTS}, m AS (SELECT doc_id, regexp_extract_all(text, {quoted(pattern)}) AS found FROM contracts)
      SELECT doc_id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS position, unnest(found) AS entity FROM m"""


def _matches(spark: SparkSession, sf_dir: str, extract) -> DataFrame:
    return contract_texts(spark, sf_dir).select(
        "doc_id", F.posexplode(extract(F.col("text"))).alias("position", "entity")
    )


@query("extract_dates", _matches_sql(extraction.DATE_PATTERN))
def extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir, extraction.extract_dates)


@query("extract_money", _matches_sql(extraction.MONEY_PATTERN))
def extract_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir, extraction.extract_money)


@query("extract_parties", _matches_sql(extraction.PARTY_PATTERN))
def extract_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir, extraction.extract_parties)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by name, products by name, and benchmark passages by their first three words."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    part, passages = table(spark, sf_dir, "part"), table(spark, sf_dir, "benchmark")
    opening = F.array_join(F.slice(tx.tokens(F.col("text"), None), 1, 3), " ")
    return (
        nation.select(F.col("n_name").alias("phrase"), F.lit("GPE").alias("label"))
        .unionByName(region.select(F.col("r_name").alias("phrase"), F.lit("GPE").alias("label")))
        .unionByName(part.select(F.col("p_name").alias("phrase"), F.lit("PRODUCT").alias("label")))
        .unionByName(passages.select(opening.alias("phrase"), F.lit("LAW").alias("label")))
    )


@query(
    "gazetteer_entities",
    f"""WITH phrases AS (
          SELECT lower(n_name) AS phrase, 'GPE' AS label FROM nation UNION SELECT lower(r_name), 'GPE' FROM region
          UNION SELECT lower(p_name), 'PRODUCT' FROM part
          UNION SELECT array_to_string(list_slice({tokens_sql('text')}, 1, 3), ' '), 'LAW' FROM benchmark),
        sized AS (SELECT phrase, label, length(phrase) - length(replace(phrase, ' ', '')) + 1 AS n FROM phrases),
        tokens AS (SELECT doc_id, regexp_extract_all(text, {quoted(tx.TOKEN_PATTERN)}) AS w, string_split_regex(text, {quoted(tx.TOKEN_PATTERN)}) AS g FROM documents),
        opened AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, unnest(g[:len(w)]) AS gap FROM tokens),
        ended AS (SELECT doc_id, i, lower(word) AS t, length(word) AS own, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM opened),
        three AS (SELECT doc_id, i, e - own AS s, t, e, lead(t) OVER d AS t2, lead(e) OVER d AS e2, lead(t, 2) OVER d AS t3, lead(e, 2) OVER d AS e3
                  FROM ended WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        grams AS (SELECT doc_id, i, 1 AS n, s, e, t AS gram FROM three UNION ALL SELECT doc_id, i, 2, s, e2, t || ' ' || t2 FROM three
                  UNION ALL SELECT doc_id, i, 3, s, e3, t || ' ' || t2 || ' ' || t3 FROM three)
        SELECT doc_id, gram AS text, label, CAST(i - 1 AS INTEGER) AS token_index, CAST(grams.n AS INTEGER) AS token_count,
               CAST(s AS INTEGER) AS start, CAST(e AS INTEGER) AS end_
        FROM grams JOIN sized ON gram = phrase AND grams.n = sized.n""",
)
def gazetteer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.gazetteer_entities(table(spark, sf_dir, "documents"), gazetteer(spark, sf_dir)).withColumnRenamed("end", "end_")


PIECE_SQL = quoted(abbreviations.EDGES)
FORM_SQL = quoted(abbreviations.WORD_FORM)
LEARNED_WORDS = f"""{sql.CONTRACTS},
        raw AS (SELECT unnest(string_split_regex(text, {SPACES_SQL})) AS p FROM contracts),
        pieces AS (SELECT regexp_replace(p, {PIECE_SQL}, '', 'g') AS p FROM raw),
        types AS (SELECT lower(regexp_replace(p, '\\.$', '')) AS word, count(*) FILTER (p LIKE '%.') AS stops, count(*) FILTER (p NOT LIKE '%.') AS plain,
                         count(*) FILTER (regexp_matches(p, '^\\p{{Ll}}')) AS small
                  FROM pieces WHERE regexp_matches(p, {FORM_SQL}) GROUP BY word),
        total AS (SELECT sum(stops) / sum(stops + plain) AS c FROM types),
        scored AS (SELECT word, stops, plain, length(replace(word, '.', '')) AS n,
                          -2 * (stops * ln(c) + plain * ln(1 - c) - stops * ln(0.99) - plain * ln(0.01)) AS ratio FROM types, total WHERE stops > 0),
        found AS (SELECT word, stops, plain, ratio * exp(-n) * (length(word) - n + 1) * pow(n, -plain) AS score FROM scored),
        short AS (SELECT * FROM found WHERE score >= 0.3)"""


@query("learned_abbreviations", f"WITH {LEARNED_WORDS} SELECT word, stops, plain, round(score + 1e-7, 2) AS score FROM short")
def learned_abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = written(abbreviations.word_types(contract_texts(spark, sf_dir)), "word-types")
    return abbreviations.abbreviations(types).withColumn("score", rounded("score", 2))


@query(
    "sentencize_learned",
    f"""WITH {LEARNED_WORDS},
        cut AS (SELECT doc_id, {sentences_sql(ws_sql('text'))} AS parts FROM contracts),
        rows AS (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS part, unnest(list_append(parts[2:], NULL)) AS after FROM cut),
        ends AS (SELECT doc_id, i, part, regexp_replace(string_split(part, ' ')[-1], {PIECE_SQL}, '', 'g') AS tail,
                        regexp_replace(string_split(after, ' ')[1], {PIECE_SQL}, '', 'g') AS head FROM rows),
        flags AS (SELECT doc_id, i, part, tail LIKE '%.' AND lower(regexp_replace(tail, '\\.$', '')) IN (SELECT word FROM short)
                         AND NOT coalesce(regexp_matches(head, '^\\p{{Lu}}') AND lower(regexp_replace(head, '\\.$', '')) IN (SELECT word FROM types WHERE small > 0), FALSE) AS goes_on
                  FROM ends),
        fresh AS (SELECT *, CASE WHEN lag(goes_on) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS f FROM flags),
        numbered AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS no FROM fresh)
        SELECT doc_id, CAST(no AS INTEGER) AS position, string_agg(part, ' ' ORDER BY i) AS sentence FROM numbered GROUP BY doc_id, no""",
)
def sentencize_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = contract_texts(spark, sf_dir).select("doc_id", tx.normalize_ws(F.col("text")).alias("text"))
    return abbreviations.sentences_without_abbreviations(spaced)


LEXICON_SQL = quoted(extraction.lexicon_pattern(extraction.OBLIGATION_WORDS))


@query(
    "extract_obligations",
    f"""WITH {sql.CONTRACTS},
        s AS (SELECT doc_id, unnest({sentences_sql(clean_sql('text'))}) AS obligation FROM contracts)
        SELECT doc_id, obligation FROM s WHERE regexp_matches(obligation, {LEXICON_SQL})""",
)
def extract_obligations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = tx.clean_text(F.col("text"), normalize=False)
    return contract_texts(spark, sf_dir).select(
        "doc_id", F.explode(extraction.extract_obligations(cleaned)).alias("obligation")
    )


NAMED_CONTRACTS = """contracts AS (SELECT o_orderkey AS doc_id, concat(c_name, ' of ', n_name,
    CASE WHEN o_orderstatus = 'F' THEN ' shall buy the ' ELSE ' bought one ' END, coalesce(p_name, 'parcel'),
    ' from Northwind Traders Inc. for $', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), ' by ', strftime(o_orderdate, '%Y-%m-%d'),
    ' under the  Fair Trade Act of 2001. ',
    CASE WHEN o_orderpriority = '1-URGENT' THEN concat('The parties must meet at the Spring', chr(9), 'Fair! ') ELSE 'Été is over. ' END,
    'Write to desk', CAST(o_custkey AS VARCHAR), '@example.com.') AS text
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON p_partkey = o_custkey)"""


def _entities_sql(source: str) -> str:
    """Tables up to ``ents``: of the patterns' and the list's spans those that a sweep from the left keeps.

    No match of a pattern occurs twice in a text, so it is found by searching.
    """
    word = quoted(tx.TOKEN_PATTERN)
    return f"""phrases AS (SELECT lower(array_to_string(regexp_extract_all(phrase, {word}), ' ')) AS phrase, len(regexp_extract_all(phrase, {word})) AS n, label
          FROM (SELECT c_name AS phrase, 'PERSON' AS label FROM customer UNION SELECT n_name, 'GPE' FROM nation UNION SELECT p_name, 'PRODUCT' FROM part
                UNION VALUES ('Northwind Traders', 'ORG'), ('Fair Trade Act', 'LAW'), ('Trade Act of 2001', 'LAW'), ('Spring Fair', 'EVENT'), ('fair', 'EVENT'))),
        words AS (SELECT doc_id, text, regexp_extract_all(text, {word}) AS ws, string_split_regex(text, {word}) AS gs FROM {source}),
        places AS (SELECT doc_id, text, ws, list_transform(range(1, len(ws) + 1), lambda i: CAST(length(array_to_string(gs[:i], '')) + length(array_to_string(ws[:i - 1], '')) AS BIGINT)) AS st FROM words),
        grams AS (SELECT doc_id, st[i] AS s, st[i + n - 1] + length(ws[i + n - 1]) AS e, lower(array_to_string(ws[i:i + n - 1], ' ')) AS gram, n
                  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM places), (SELECT DISTINCT n FROM phrases) WHERE i + n - 1 <= len(ws)),
        found AS (SELECT doc_id, s, e, 1 AS rank, label FROM grams JOIN phrases ON gram = phrase AND grams.n = phrases.n
          UNION SELECT doc_id, strpos(text, m) - 1, strpos(text, m) - 1 + length(m), 0,
                       CASE WHEN regexp_full_match(m, {quoted(extraction.MONEY_PATTERN)}) THEN 'MONEY'
                            WHEN regexp_full_match(m, {quoted(extraction.DATE_PATTERN)}) THEN 'DATE' ELSE 'ORG' END
          FROM (SELECT doc_id, text, unnest(regexp_extract_all(text, {quoted(extraction.ANY_ENTITY)})) AS m FROM {source})),
        sweep AS (SELECT doc_id, min(struct_pack(s := s, stop := -e, rank := rank, label := label)) AS k FROM found GROUP BY doc_id
          UNION ALL SELECT found.doc_id, min(struct_pack(s := found.s, stop := -found.e, rank := found.rank, label := found.label))
          FROM sweep JOIN found ON found.doc_id = sweep.doc_id AND found.s >= -sweep.k.stop GROUP BY found.doc_id),
        ents AS (SELECT sweep.doc_id, k.label AS label, k.s AS s, -k.stop AS e, substr(text, CAST(k.s + 1 AS BIGINT), CAST(-k.stop - k.s AS BIGINT)) AS text
                 FROM sweep JOIN {source} AS src ON src.doc_id = sweep.doc_id)"""


@query(
    "entity_table",
    f"""WITH RECURSIVE {NAMED_CONTRACTS}, {_entities_sql("contracts")}
        SELECT doc_id, text, label, CAST(s AS INTEGER) AS start, CAST(e AS INTEGER) AS end_, CAST(1 AS DOUBLE) AS confidence FROM ents""",
)
def entity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight types: patterns and list, without overlap."""
    found = documents.entity_table(named_contracts(spark, sf_dir), gazetteer=named_phrases(spark, sf_dir))
    return found.withColumnRenamed("end", "end_")


def _of_type_sql(pattern: str) -> str:
    return f"array_to_string(list_filter(found, lambda e: regexp_full_match(e, {quoted(pattern)})), '|')"


def _listed_sql(labels: str) -> str:
    return f"coalesce(string_agg(ents.text, '|' ORDER BY s) FILTER (label IN ({labels})), '')"


@query(
    "extraction_result",
    f"""WITH RECURSIVE {NAMED_CONTRACTS},
        c AS (SELECT doc_id, {clean_sql('text')} AS text FROM contracts), {_entities_sql("c")},
        d AS (SELECT doc_id, array_to_string(list_filter({sentences_sql('text')}, lambda s: regexp_matches(s, {LEXICON_SQL})), '|') AS obligations FROM c)
        SELECT d.doc_id, CAST(count(ents.text) AS INTEGER) AS entity_count, coalesce(string_agg(label || '=' || ents.text, '|' ORDER BY s), '') AS entities,
               any_value(obligations) AS obligations, {_listed_sql("'DATE'")} AS dates, {_listed_sql("'MONEY'")} AS monetary_values,
               {_listed_sql("'ORG', 'PERSON'")} AS parties
        FROM d LEFT JOIN ents ON ents.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def extraction_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.extraction_result(named_contracts(spark, sf_dir), normalize=False, gazetteer=named_phrases(spark, sf_dir))
    return out.select(
        "doc_id",
        "entity_count",
        F.concat_ws("|", F.transform("entities", lambda e: F.concat_ws("=", e["label"], e["text"]))).alias("entities"),
        *[joined(c).alias(c) for c in ("obligations", "dates", "monetary_values", "parties")],
    )


HELD_OUT = "CAST(conv(substr(md5(phrase), 1, 8), 16, 10) AS BIGINT) % 5 = 0"


@query(
    "learned_parties",
    f"""WITH RECURSIVE {NAMED_CONTRACTS},
        c AS (SELECT doc_id, {clean_sql('text')} AS text FROM contracts), {_entities_sql("c")}
        SELECT c.doc_id, CAST(concat('0x', substr(md5(regexp_extract(any_value(c.text), '^[^ ]+')), 1, 8)) AS BIGINT) % 5 = 0 AS held_out,
               {_listed_sql("'ORG', 'PERSON'")} AS parties
        FROM c LEFT JOIN ents ON ents.doc_id = c.doc_id GROUP BY c.doc_id""",
)
def learned_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties where a fifth of the customers is on no list: a tagger taught by the others finds them.

    The SQL has the whole list, so a person overlooked or a phrase taken for one is a difference.
    """
    docs, phrases = named_contracts(spark, sf_dir), named_phrases(spark, sf_dir)
    listed = phrases.where(f"label <> 'PERSON' OR NOT ({HELD_OUT})")
    model = tagger.fit_tagger(tagger.tagged_tokens(docs, listed))
    out = documents.extraction_result(docs, normalize=False, gazetteer=listed, finder=model.find)
    name = docs.select("doc_id", F.expr("regexp_extract(text, '^[^ ]+', 0)").alias("phrase")).select("doc_id", F.expr(HELD_OUT).alias("held_out"))
    return out.join(name, "doc_id").select("doc_id", "held_out", joined("parties").alias("parties"))


@query(
    "extract_batch",
    f"""WITH t AS (SELECT concat('doc_', CAST(row_number() OVER () - 1 AS VARCHAR)) AS doc_id, {clean_sql('text')} AS t
                   FROM conversations),
        f AS (SELECT doc_id, regexp_extract_all(t, {quoted(extraction.ANY_ENTITY)}) AS found,
                     list_filter({sentences_sql('t')}, lambda s: regexp_matches(s, {LEXICON_SQL})) AS duties, t FROM t)
        SELECT doc_id, CAST(len(found) AS INTEGER) AS entity_count, {_of_type_sql(extraction.DATE_PATTERN)} AS dates,
               array_to_string(duties, '|') AS obligations, length(t) AS chars FROM f""",
)
def extract_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns have no document id, so they are numbered; their length shows the order."""
    turns = documents.with_document_ids(table(spark, sf_dir, "conversations").select("text"))
    lengths = turns.select("doc_id", F.length(tx.clean_text(F.col("text"), normalize=False)).cast("bigint").alias("chars"))
    found = documents.extract_batch(table(spark, sf_dir, "conversations").select("text"), normalize=False)
    return found.join(lengths, "doc_id").select(
        "doc_id", "entity_count", joined("dates").alias("dates"), joined("obligations").alias("obligations"), "chars"
    )


@query(
    "compliance_flags",
    f"""WITH {sql.CONTRACTS}, every_text AS (
          SELECT concat('contract', CAST(doc_id AS VARCHAR)) AS doc_id, text FROM contracts
          UNION ALL SELECT concat('doc', CAST(doc_id AS VARCHAR)), text FROM documents),
        f AS (SELECT doc_id, regexp_matches(text, {LEXICON_SQL}) AS has_obligation,
                regexp_matches(text, {quoted(extraction.MONEY_PATTERN)}) AS has_money,
                regexp_matches(text, {quoted(extraction.DATE_PATTERN)}) AS has_date,
                regexp_matches(text, {EMAIL_SQL}) AS has_email, regexp_matches(text, {URL_SQL}) AS has_url
              FROM every_text)
        SELECT *, has_obligation AND (has_money OR has_date) AS needs_review FROM f""",
)
def compliance_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = contract_texts(spark, sf_dir).select(
        F.concat(F.lit("contract"), F.col("doc_id").cast("string")).alias("doc_id"), "text"
    )
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("doc_id"), "text"
    )
    return documents.compliance_flags(made.unionByName(docs)).drop("text")
