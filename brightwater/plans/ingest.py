"""Sources, sinks and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.operators import quality, tables
from brightwater.operators.features import customer_features, demand_features, select_features
from brightwater.functions import contracts
from brightwater.plans import sql
from brightwater.plans.registry import joined, query, rounded, stamp
from brightwater.schema import CHURN_FEATURES
from brightwater.session import scratch_path
from brightwater.sources import files
from brightwater.sources.adapters import customer_events, flawed_events, table


def event_output(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(
        "event_id",
        "customer_id",
        "event_type",
        "region",
        "product_id",
        "quantity",
        "revenue",
        "session_duration_sec",
        stamp("timestamp").alias("event_time"),
        "date",
        *more,
    )


INGESTED = f"WITH {sql.CLEAN_FLAWED} SELECT {sql.EVENT_OUT} FROM dated"


@query("ingest_parquet", INGESTED)
def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_parquet")
    flawed_events(spark, sf_dir).write.parquet(path)
    return event_output(files.ingest_parquet(spark, path))


@query("ingest_json", INGESTED)
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_json")
    flawed_events(spark, sf_dir).write.option("compression", "gzip").json(path)
    return event_output(files.ingest_json(spark, path))


@query("ingest_csv", INGESTED)
def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_csv")
    flawed_events(spark, sf_dir).write.option("header", "true").csv(path)
    return event_output(files.ingest_csv(spark, path))


@query("ingest_table", INGESTED)
def ingest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"events_{uuid.uuid4().hex}"
    flawed_events(spark, sf_dir).write.option("path", scratch_path(spark, "events_table")).saveAsTable(name)
    return event_output(files.ingest_table(spark, name))


@query(
    "schema_enforce",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, concat('U', CAST(user_id AS VARCHAR)) AS customer_id, event_type,
         CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS INTEGER) AS quantity,
         value AS revenue, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS session_duration_sec,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(NULL AS VARCHAR) AS date, 'quantity' AS cast_errors
       FROM events""",
)
def schema_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_id"),
        "event_type",
        F.col("props").alias("quantity"),
        F.col("value").alias("revenue"),
        F.regexp_extract("props", "[0-9]+", 0).alias("session_duration_sec"),
        F.col("ts").alias("timestamp"),
    )
    shaped = files.enforce_schema(raw, keep_errors=True)
    return event_output(shaped, joined("_cast_errors").alias("cast_errors"))


ALL_CE = f"WITH {sql.CE} SELECT {sql.EVENT_OUT} FROM ce"


@query("write_append", ALL_CE)
def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append")
    line = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    tables.append(customer_events(spark, sf_dir, line.filter(returned)), path)
    tables.append(customer_events(spark, sf_dir, line.filter(~returned)), path)
    return event_output(tables.read(spark, path))


@query(
    "write_overwrite",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    customer = table(spark, sf_dir, "customer")
    tables.overwrite(customer.withColumn("c_acctbal", F.lit(0.0)), path)
    tables.overwrite(customer, path)
    return tables.read(spark, path)


@query(
    "merge_upsert",
    """WITH source AS (
         SELECT o_custkey * 2 AS custkey, 'ACTIVE' AS segment, max(o_totalprice) AS balance, count(*) AS orders
         FROM orders GROUP BY o_custkey)
       SELECT c_custkey AS custkey, c_mktsegment AS segment, c_acctbal AS balance, CAST(NULL AS BIGINT) AS orders
       FROM customer WHERE c_custkey NOT IN (SELECT custkey FROM source)
       UNION ALL SELECT custkey, segment, balance, orders FROM source""",
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = scratch_path(spark, "upsert_target"), scratch_path(spark, "upsert_out")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    ).write.parquet(path)
    source = (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") * 2).alias("custkey"))
        .agg(F.lit("ACTIVE").alias("segment"), F.max("o_totalprice").alias("balance"), F.count(F.lit(1)).alias("orders"))
    )
    tables.upsert_table(spark, path, source, ["custkey"], out)
    return tables.read(spark, out)


PARTED = "CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE concat('0', CAST(c_nationkey % 5 AS VARCHAR)) END"


@query(
    "upsert_partitions",
    f"""WITH target AS (SELECT {PARTED} AS part, c_custkey AS id, c_acctbal AS balance FROM customer),
        source AS (SELECT part, id, CAST(0 AS DOUBLE) AS balance FROM target WHERE id % 7 = 0 AND (part IS NULL OR part = '01'))
        SELECT part, id, balance FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.part = t.part AND s.id = t.id)
        UNION ALL SELECT part, id, balance FROM source""",
)
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partitions touched, one of them null; a null key matches nothing, so its rows are added."""
    path = scratch_path(spark, "upsert_partitions")
    part = F.when(F.col("c_nationkey") % 5 != 0, F.concat(F.lit("0"), (F.col("c_nationkey") % 5).cast("string")))
    rows = table(spark, sf_dir, "customer").select(part.alias("part"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    tables.overwrite(rows, path, ["part"])
    source = rows.where("id % 7 = 0 AND (part IS NULL OR part = '01')").withColumn("balance", F.lit(0.0))
    tables.upsert_partitions(spark, path, source, ["part", "id"], ["part"], schema=rows.schema)
    return tables.read(spark, path, schema=rows.schema).select("part", "id", "balance")


@query(
    "write_partitioned",
    f"""WITH {sql.CE} SELECT event_id, customer_id, product_id, quantity, revenue, region,
          CAST(strftime(timestamp, '%Y') AS INTEGER) AS year FROM ce""",
)
def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    rows = customer_events(spark, sf_dir).select(
        "event_id", "customer_id", "product_id", "quantity", "revenue", "region", F.year("timestamp").alias("year")
    )
    tables.overwrite(rows, path, ["year", "region"])
    return tables.read(spark, path)


@query(
    "schema_evolution",
    """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS INTEGER) AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "evolving")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    tables.append(customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    tables.append(
        supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
        ),
        path,
    )
    return tables.read(spark, path)


@query(
    "compact_table",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, o_orderpriority FROM orders""",
)
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = scratch_path(spark, "small_files"), scratch_path(spark, "compacted")
    table(spark, sf_dir, "orders").repartition(16).write.parquet(path)
    tables.compact_table(spark, path, out, sort_by=["o_custkey"])
    return tables.read(spark, out).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        stamp("o_orderdate").alias("order_time"),
        "o_orderpriority",
    )


@query(
    "compact_z_order",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, o_orderpriority FROM orders""",
)
def compact_z_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = scratch_path(spark, "small_files"), scratch_path(spark, "z_ordered")
    table(spark, sf_dir, "orders").repartition(16).write.parquet(path)
    tables.compact_z_order(spark, path, out, ["o_custkey", "o_orderdate", "o_orderpriority"], target_file_bytes=1 << 18)
    return tables.read(spark, out).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        stamp("o_orderdate").alias("order_time"),
        "o_orderpriority",
    )


_EXPORT = ", ".join(sql.r(c) for c in CHURN_FEATURES)


@query(
    "feature_export",
    f"WITH {sql.CE}, {sql.customer_features()} SELECT customer_id, region, {_EXPORT} FROM features",
)
def feature_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = customer_features(customer_events(spark, sf_dir), sql.AS_OF)
    exported = tables.feature_export(features, CHURN_FEATURES, keep=["customer_id", "region"])
    return exported.select("customer_id", "region", *[rounded(c).alias(c) for c in CHURN_FEATURES])


@query("filter_mandatory", f"WITH {sql.FLAWED} SELECT {sql.EVENT_OUT} FROM flawed WHERE {sql.MANDATORY}")
def filter_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_output(quality.filter_mandatory(flawed_events(spark, sf_dir)))


@query("filter_anomalies", f"WITH {sql.FLAWED} SELECT {sql.EVENT_OUT} FROM flawed WHERE {sql.PLAUSIBLE}")
def filter_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_output(quality.filter_anomalies(flawed_events(spark, sf_dir)))


@query("dedup_latest", f"WITH {sql.CE}, {sql.latest('ce')} SELECT {sql.EVENT_OUT} FROM clean")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_output(quality.dedup_latest(customer_events(spark, sf_dir)))


@query(
    "dedup_latest_one",
    f"""WITH {sql.CE} SELECT {sql.EVENT_OUT} FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY timestamp DESC, product_id DESC, revenue DESC,
            customer_id DESC) AS n FROM ce) WHERE n = 1""",
)
def dedup_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = customer_events(spark, sf_dir)
    return event_output(quality.dedup_latest(events, ties="one", tie_break=["product_id", "revenue", "customer_id"]))


@query(
    "add_partition_date",
    f"WITH {sql.FLAWED}, {sql.dated('flawed')} SELECT {sql.EVENT_OUT} FROM dated",
)
def add_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_output(quality.add_partition_date(flawed_events(spark, sf_dir)))


@query(
    "fill_partition_date",
    f"""WITH {sql.FLAWED}, filled AS (
          SELECT * REPLACE (coalesce(date, strftime(timestamp, '%Y-%m-%d')) AS date) FROM flawed)
        SELECT {sql.EVENT_OUT} FROM filled""",
)
def fill_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_output(quality.add_partition_date(flawed_events(spark, sf_dir), mode="fill"))


STATS = f"""WITH {sql.CLEAN_FLAWED},
  n AS (SELECT (SELECT count(*) FROM flawed) AS records_read, (SELECT count(*) FROM clean) AS records_valid),
  stats AS (SELECT 'lineitem' AS source, records_read, records_valid, records_read - records_valid AS records_rejected,
                   round(records_valid / records_read, 6) AS reliability FROM n)"""


@query("ingestion_stats", f"{STATS} SELECT * FROM stats")
def ingestion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.ingestion_stats(flawed_events(spark, sf_dir), "lineitem")
    return stats.withColumn("reliability", F.round("reliability", 6))


@query(
    "reliability_alert",
    f"{STATS} SELECT *, CAST(0.998 AS DOUBLE) AS target, reliability < 0.998 AS below_target FROM stats",
)
def reliability_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reliability_alert(ingestion_stats(spark, sf_dir))


@query(
    "dead_letter",
    f"""WITH {sql.FLAWED},
        tagged AS (SELECT *, concat_ws('|',
            CASE WHEN event_id IS NULL THEN 'event_id_missing' END,
            CASE WHEN customer_id IS NULL THEN 'customer_id_missing' END,
            CASE WHEN timestamp IS NULL THEN 'timestamp_missing' END,
            CASE WHEN revenue < 0 THEN 'revenue_negative' END,
            CASE WHEN quantity < 0 THEN 'quantity_negative' END) AS reasons FROM flawed),
        ranked AS (SELECT *, rank() OVER (PARTITION BY event_id ORDER BY timestamp DESC) AS rk
                   FROM tagged WHERE reasons = ''),
        dead AS (SELECT * FROM tagged WHERE reasons <> ''
                 UNION ALL SELECT * EXCLUDE (rk) REPLACE ('superseded_duplicate' AS reasons) FROM ranked WHERE rk > 1)
        SELECT {sql.EVENT_OUT}, reasons FROM dead""",
)
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quality.dead_letter(flawed_events(spark, sf_dir))
    return event_output(rejected, joined("reasons").alias("reasons"))


EARLY = "2000-01-01"


@query(
    "validate_churn_contract",
    f"""WITH {sql.CE}, {sql.customer_features(EARLY)}
        SELECT customer_id, region, concat_ws('|',
          CASE WHEN days_since_last_event < 0 THEN 'days_since_last_event_negative' END,
          CASE WHEN customer_tenure_days < 0 THEN 'customer_tenure_days_negative' END,
          CASE WHEN engagement_score < 0 THEN 'engagement_score_negative' END,
          CASE WHEN engagement_score > 1 THEN 'engagement_score_above_one' END) AS violations
        FROM features""",
)
def validate_churn_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contracts.validate_churn(customer_features(customer_events(spark, sf_dir), EARLY))
    return checked.select("customer_id", "region", joined("violations").alias("violations"))


@query(
    "validate_demand_contract",
    f"""WITH {sql.FLAWED}, {sql.demand("flawed")}
        SELECT date, product_id, region, concat_ws('|',
          CASE WHEN region IS NULL THEN 'region_missing' END,
          CASE WHEN daily_units IS NULL THEN 'daily_units_missing' END,
          CASE WHEN daily_revenue IS NULL THEN 'daily_revenue_missing' END) AS violations
        FROM daily""",
)
def validate_demand_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contracts.validate_demand(demand_features(flawed_events(spark, sf_dir)))
    return checked.select("date", "product_id", "region", joined("violations").alias("violations"))


@query(
    "validate_document",
    """WITH d AS (SELECT CASE WHEN turn = 0 THEN NULL ELSE CAST(conv_id AS VARCHAR) END AS doc_id,
                    CASE WHEN role = 'user' AND turn = 2 THEN substr(text, 1, 8) ELSE text END AS text FROM conversations
                  UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents)
       SELECT coalesce(doc_id, 'doc') AS doc_id, text,
         CASE WHEN text IS NULL THEN 'text_missing' WHEN length(text) < 10 THEN 'text_too_short' ELSE '' END AS violations
       FROM d""",
)
def validate_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select(
        F.when(F.col("turn") != 0, F.col("conv_id").cast("string")).alias("doc_id"),
        F.when((F.col("role") == "user") & (F.col("turn") == 2), F.substring("text", 1, 8))
        .otherwise(F.col("text"))
        .alias("text"),
    )
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    checked = contracts.validate_document(talk.unionByName(docs))
    return checked.select("doc_id", "text", joined("violations").alias("violations"))


@query(
    "select_features",
    f"WITH {sql.CE}, {sql.customer_features()} SELECT {_EXPORT} FROM features",
)
def select_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_features(customer_features(customer_events(spark, sf_dir), sql.AS_OF), CHURN_FEATURES)
    return chosen.select(*[rounded(c).alias(c) for c in CHURN_FEATURES])
