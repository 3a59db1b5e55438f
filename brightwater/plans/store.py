"""Memoised scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.functions.keys import score_key
from brightwater.operators import store
from brightwater.operators.bucketed import BucketedStore, open_store
from brightwater.plans.registry import query, stamp
from brightwater.session import scratch_path
from brightwater.sources.adapters import table

NOW = "1999-06-01 00:00:00"
PAYLOAD = ["o_orderpriority", "o_custkey"]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per order; customers ask for the same payload again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *PAYLOAD)
    return orders.withColumn("key", score_key("churn", PAYLOAD))


def earlier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store holding results of finished orders, some of them out of date."""
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    results = done.groupBy(*PAYLOAD).agg(
        F.count(F.lit(1)).alias("prediction"), F.max("o_orderdate").cast("timestamp").alias("written_at")
    )
    return results.select(
        score_key("churn", PAYLOAD).alias("key"),
        F.to_json(F.struct("prediction")).alias("value"),
        "written_at",
        F.lit(365 * 86400).alias("ttl_seconds"),
    )


KEY_SQL = """concat('churn:', substr(sha256(concat('{"o_custkey": ', CAST(o_custkey AS VARCHAR),
  ', "o_orderpriority": "', o_orderpriority, '"}')), 1, 16))"""
REQUESTS = f"requests AS (SELECT o_orderkey, o_orderpriority, o_custkey, {KEY_SQL} AS key FROM orders)"
STORE = f"""results AS (
  SELECT o_orderpriority, o_custkey, count(*) AS prediction, max(o_orderdate) AS written_at
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority, o_custkey),
store AS (SELECT {KEY_SQL} AS key, concat('{{"prediction":', CAST(prediction AS VARCHAR), '}}') AS value, written_at,
                 {365 * 86400} AS ttl_seconds FROM results)"""
LIVE = f"written_at + INTERVAL 365 DAYS > TIMESTAMP '{NOW}'"
LOOKUP = f"""WITH {REQUESTS}, {STORE}, live AS (SELECT key, value FROM store WHERE {LIVE}),
  looked AS (SELECT requests.key, o_orderkey, o_orderpriority, o_custkey, value, value IS NOT NULL AS cached
             FROM requests LEFT JOIN live ON requests.key = live.key)"""
STORE_OUT = "key, value, strftime(written_at, '%Y-%m-%d %H:%M:%S') AS written, ttl_seconds"


def store_output(df: DataFrame) -> DataFrame:
    return df.select("key", "value", stamp("written_at").alias("written"), "ttl_seconds")


@query("score_key", f"WITH {REQUESTS} SELECT o_orderkey, key FROM requests")
def score_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir).select("o_orderkey", "key")


@query("score_lookup", f"{LOOKUP} SELECT * FROM looked")
def score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.score_lookup(requests(spark, sf_dir), earlier_scores(spark, sf_dir), NOW)


PUT = f"""WITH {REQUESTS}, {STORE},
        fresh AS (SELECT key, '{{"prediction":0}}' AS value, TIMESTAMP '{NOW}' AS written_at, 300 AS ttl_seconds
                  FROM requests JOIN orders USING (o_orderkey) WHERE o_orderstatus = 'O' GROUP BY key),
        merged AS (SELECT * FROM store WHERE key NOT IN (SELECT key FROM fresh) UNION ALL SELECT * FROM fresh)
        SELECT {STORE_OUT} FROM merged"""


def bucketed_scores(spark: SparkSession, sf_dir: str) -> BucketedStore:
    """The earlier scores in a bucketed store; few buckets, as the tables are small."""
    path = scratch_path(spark, "bucketed")
    kept = open_store(spark, path, path.rsplit("/", 1)[1].replace("-", "_"), buckets=16, shards=4)
    kept.put(earlier_scores(spark, sf_dir))
    return kept


@query("bucketed_lookup", f"{LOOKUP} SELECT * FROM looked")
def bucketed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucketed_scores(spark, sf_dir).lookup(requests(spark, sf_dir), NOW)


@query("bucketed_put", PUT)
def bucketed_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    fresh = pending.select(score_key("churn", PAYLOAD).alias("key")).distinct()
    kept = bucketed_scores(spark, sf_dir)
    kept.put(store.store_entries(fresh.withColumn("value", F.lit('{"prediction":0}')), NOW, ttl_seconds=0))
    return store_output(kept.rows())


@query("score_put", PUT)
def score_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    fresh = pending.select(score_key("churn", PAYLOAD).alias("key")).distinct()
    entries = store.store_entries(fresh.withColumn("value", F.lit('{"prediction":0}')), NOW, ttl_seconds=0)
    return store_output(store.score_put(earlier_scores(spark, sf_dir), entries))


@query(
    "score_delete",
    f"""WITH {REQUESTS}, {STORE}
        SELECT {STORE_OUT} FROM store WHERE key NOT IN (SELECT key FROM requests WHERE o_orderpriority = '5-LOW')""",
)
def score_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = requests(spark, sf_dir).filter("o_orderpriority = '5-LOW'").select("key")
    return store_output(store.score_delete(earlier_scores(spark, sf_dir), gone))


@query(
    "score_invalidate",
    f"""WITH {STORE}, marked AS (SELECT *, regexp_matches(key, '^churn:[0-3a]') AS hit FROM store)
        SELECT {STORE_OUT}, (SELECT count(*) FROM marked WHERE hit) AS removed FROM marked WHERE NOT hit""",
)
def score_invalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remaining store; the count of removed keys stands beside every row."""
    left, removed = store.score_invalidate(earlier_scores(spark, sf_dir), "churn:[0-3a]*")
    return store_output(left).withColumn("removed", removed.scalar())


@query(
    "hit_rate",
    f"""{LOOKUP} SELECT count(*) FILTER (WHERE cached) AS hits, count(*) FILTER (WHERE NOT cached) AS misses,
          round(count(*) FILTER (WHERE cached) / count(*), 4) AS hit_rate FROM looked""",
)
def hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.hit_rate(score_lookup(spark, sf_dir))


def _priority_model(payloads: DataFrame) -> DataFrame:
    """Stands in for a model: priority class and a share of the customer number."""
    return payloads.withColumns(
        {
            "prediction": F.substring("o_orderpriority", 1, 1).cast("double"),
            "churn_probability": F.round(F.col("o_custkey") / (F.col("o_custkey") + 100), 4),
        }
    )


@query(
    "score_with_store",
    f"""{LOOKUP} SELECT o_orderkey, o_orderpriority, o_custkey, cached,
          CASE WHEN cached THEN CAST(regexp_extract(value, '[0-9]+') AS DOUBLE)
               ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS prediction,
          CASE WHEN NOT cached THEN round(o_custkey / (o_custkey + 100), 4) END AS churn_probability
        FROM looked""",
)
def score_with_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = requests(spark, sf_dir).drop("key")
    answers, _ = store.score_with_store(
        asked, earlier_scores(spark, sf_dir), PAYLOAD, _priority_model, ["prediction", "churn_probability"], as_of=NOW
    )
    return answers


@query(
    "score_write_back",
    f"""{LOOKUP}, fresh AS (SELECT DISTINCT key FROM looked WHERE NOT cached)
        SELECT key, written_at = TIMESTAMP '{NOW}' AS fresh FROM (
          SELECT key, TIMESTAMP '{NOW}' AS written_at FROM fresh
          UNION ALL SELECT key, written_at FROM store WHERE key NOT IN (SELECT key FROM fresh))""",
)
def score_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after the misses are scored, written out and read again."""
    asked = requests(spark, sf_dir).drop("key")
    _, after = store.score_with_store(
        asked, earlier_scores(spark, sf_dir), PAYLOAD, _priority_model, ["prediction", "churn_probability"], as_of=NOW
    )
    path = scratch_path(spark, "store")
    after.write.parquet(path)
    return spark.read.parquet(path).select("key", (F.col("written_at") == F.lit(NOW).cast("timestamp")).alias("fresh"))


def _length_labels(payloads: DataFrame) -> DataFrame:
    """Stands in for a document classifier."""
    return payloads.withColumns({"label": F.when(F.char_length("text") > 1000, "long").otherwise("short"), "confidence": F.lit(0.5)})


@query(
    "document_labels_with_store",
    """WITH hit AS (SELECT DISTINCT text FROM documents WHERE doc_id % 3 = 0)
       SELECT doc_id, CASE WHEN hit.text IS NOT NULL THEN 'legal' WHEN length(d.text) > 1000 THEN 'long' ELSE 'short' END AS label,
              CASE WHEN hit.text IS NOT NULL THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS confidence,
              hit.text IS NOT NULL AS cached
       FROM documents d LEFT JOIN hit ON d.text = hit.text""",
)
def document_labels_with_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored results with text labels: a third of the documents was labelled before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    earlier = docs.where("doc_id % 3 = 0").select(score_key("document", ["text"]).alias("key")).distinct()
    earlier = earlier.withColumn("value", F.to_json(F.struct(F.lit("legal").alias("label"), F.lit(0.25).alias("confidence"))))
    known = store.store_entries(earlier, NOW)
    answers, _ = store.score_with_store(docs, known, ["text"], _length_labels, ["label", "confidence"], prefix="document", as_of=NOW)
    return answers.select("doc_id", "label", "confidence", "cached")
