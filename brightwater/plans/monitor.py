"""Monitoring aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.operators import monitor
from brightwater.plans import sql
from brightwater.plans.registry import query, rounded
from brightwater.sources.adapters import table


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events read as a log of predictions by four models."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("label"),
        (F.col("value") / 50).alias("latency_seconds"),
        (F.col("value") < 10).alias("cached"),
        F.round(F.lit(1.0) - F.col("value") / 1000, 6).alias("accuracy"),
        F.when(F.col("value") > 5, F.round(F.lit(1.0) - F.col("value") / 2000, 6)).alias("roc_auc"),
        "event_type",
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
    )


LOG = """log AS (
  SELECT concat('model_', CAST(user_id % 4 AS VARCHAR)) AS model_name,
         CASE WHEN event_type <> 'view' THEN event_type END AS label, value / 50 AS latency_seconds, value < 10 AS cached,
         round(CAST(1 AS DOUBLE) - value / 1000, 6) AS accuracy,
         CASE WHEN value > 5 THEN round(CAST(1 AS DOUBLE) - value / 2000, 6) END AS roc_auc, event_type, event_id, ts
  FROM events)"""


@query(
    "predictions_total",
    f"WITH {LOG} SELECT model_name, coalesce(label, 'unknown') AS label, count(*) AS predictions FROM log GROUP BY ALL",
)
def predictions_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.predictions_total(prediction_log(spark, sf_dir))


@query(
    "errors_total",
    f"""WITH {LOG} SELECT model_name, CASE WHEN cached THEN 'unknown' ELSE 'timeout' END AS error_type, count(*) AS errors
        FROM log WHERE event_type = 'error' GROUP BY ALL""",
)
def errors_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = prediction_log(spark, sf_dir).filter("event_type = 'error'")
    return monitor.errors_total(failed.withColumn("error_type", F.when(~F.col("cached"), "timeout")))


_HISTOGRAM = " UNION ALL ".join(
    f"SELECT model_name, '{le}' AS le, count(*) FILTER (WHERE {test}) AS cumulative, count(*) AS latency_count, "
    "round(sum(latency_seconds), 4) AS latency_sum FROM log GROUP BY model_name"
    for le, test in [(str(b), f"latency_seconds <= CAST({b} AS DOUBLE)") for b in monitor.LATENCY_BUCKETS] + [("+Inf", "TRUE")]
)


@query("latency_histogram", f"WITH {LOG} {_HISTOGRAM}")
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.latency_histogram(prediction_log(spark, sf_dir)).withColumn("latency_sum", F.round("latency_sum", 4))


@query(
    "accuracy_gauge",
    f"""WITH {LOG}, g AS (SELECT model_name, arg_max(accuracy, (ts, accuracy)) AS accuracy FROM log GROUP BY model_name)
        SELECT *, accuracy < CAST(0.85 AS DOUBLE) AS alert FROM g""",
)
def accuracy_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.accuracy_gauge(prediction_log(spark, sf_dir))


@query(
    "roc_auc_gauge",
    f"""WITH {LOG} SELECT model_name, arg_max(roc_auc, (ts, roc_auc)) AS roc_auc FROM log WHERE roc_auc IS NOT NULL
        GROUP BY model_name""",
)
def roc_auc_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.roc_auc_gauge(prediction_log(spark, sf_dir))


@query(
    "ingest_run_stats",
    """WITH runs AS (
         SELECT concat('ingest_', o_orderpriority) AS pipeline_name, CAST(o_custkey + 1 AS BIGINT) AS records,
                round(CAST(1 AS DOUBLE) - o_totalprice / 100000000, 8) AS reliability, o_orderdate AS ts FROM orders)
       SELECT pipeline_name, CAST(sum(records) AS BIGINT) AS records_processed,
              arg_max(reliability, (ts, reliability)) AS reliability FROM runs GROUP BY pipeline_name""",
)
def ingest_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ingest_"), F.col("o_orderpriority")).alias("pipeline_name"),
        (F.col("o_custkey") + 1).alias("records"),
        F.round(F.lit(1.0) - F.col("o_totalprice") / 100000000, 8).alias("reliability"),
        F.col("o_orderdate").alias("ts"),
    )
    return monitor.ingest_run_stats(runs)


@query(
    "store_hits_misses",
    f"""WITH {LOG} SELECT model_name, count(*) FILTER (WHERE cached) AS hits, count(*) FILTER (WHERE NOT cached) AS misses
        FROM log GROUP BY model_name""",
)
def store_hits_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.store_hits_misses(prediction_log(spark, sf_dir))


DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "price_per_unit"]


def _samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Returned items against the rest, with a feature that doubles."""
    line = table(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    returned = F.col("l_returnflag") == "R"
    line = line.withColumn("price_per_unit", F.when(returned, unit).otherwise(unit * 2.0))
    return line.filter(returned).select(*DRIFT_FEATURES), line.filter(~returned).select(*DRIFT_FEATURES)


def _psi_sql() -> str:
    probabilities = ", ".join(str(i / 10) for i in range(1, 10))
    parts = []
    for f in DRIFT_FEATURES:
        parts.append(f"""SELECT 'shipping' AS model_name, '{f}' AS feature_name, {sql.r('sum((a - e) * ln(a / e))', 'psi')} FROM (
          SELECT bin, greatest(count(*) FILTER (WHERE returned) / (SELECT count(*) FROM line WHERE returned), 1e-4) AS e,
                 greatest(count(*) FILTER (WHERE NOT returned) / (SELECT count(*) FROM line WHERE NOT returned), 1e-4) AS a
          FROM (SELECT returned, len(list_filter(cuts, lambda c: {f} > c)) AS bin FROM line,
                 (SELECT list_distinct(quantile_cont({f}, [{probabilities}])) AS cuts FROM line WHERE returned))
          GROUP BY bin)""")
    return f"""WITH line AS (
        SELECT l_returnflag = 'R' AS returned, l_quantity, l_extendedprice, l_discount,
               CASE WHEN l_returnflag = 'R' THEN l_extendedprice / l_quantity
                    ELSE (l_extendedprice / l_quantity) * CAST(2.0 AS DOUBLE) END AS price_per_unit FROM lineitem)
      {' UNION ALL '.join(parts)}"""


@query("psi_drift", _psi_sql())
def psi_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline, current = _samples(spark, sf_dir)
    drift = monitor.psi_drift(baseline, current, DRIFT_FEATURES, "shipping")
    return drift.withColumn("psi", rounded("psi"))


@query("drift_alert", f"SELECT * FROM ({_psi_sql()}) WHERE psi > 0.2")
def drift_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.drift_alert(psi_drift(spark, sf_dir))
