"""Streaming ingestion, run until the waiting files are consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.plans import sql
from brightwater.plans.ingest import event_output
from brightwater.plans.registry import joined, query
from brightwater.session import scratch_path
from brightwater.sources.adapters import customer_events, flawed_events, table
from brightwater.streaming import ingest


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "lineitem").schema
    return ingest.stream_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem*.parquet", schema)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_events(spark, sf_dir, line_stream(spark, sf_dir))


def flawed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flawed_events(spark, sf_dir, line_stream(spark, sf_dir))


@query(
    "stream_parquet",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""",
)
def stream_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream_copy")
    rows = line_stream(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    ingest.stream_sink(rows, path, scratch_path(spark, "checkpoint"), partition_by=None).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_sink",
    f"""WITH {sql.CE} SELECT {sql.EVENT_OUT.replace(', date', ", strftime(timestamp, '%Y-%m-%d') AS date")} FROM ce""",
)
def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by region: the generated dates would make thousands of tiny files."""
    path = scratch_path(spark, "stream_table")
    clean = ingest.clean_stream(event_stream(spark, sf_dir))
    ingest.stream_sink(clean, path, scratch_path(spark, "checkpoint"), partition_by=["region"]).awaitTermination()
    return event_output(spark.read.parquet(path))


@query(
    "stream_ingest",
    f"""WITH {sql.FLAWED}, kept AS (
          SELECT * REPLACE (coalesce(date, strftime(timestamp, '%Y-%m-%d')) AS date) FROM flawed
          WHERE {sql.MANDATORY} AND {sql.PLAUSIBLE})
        SELECT {sql.EVENT_OUT} FROM kept""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream_ingested")
    clean = ingest.clean_stream(flawed_stream(spark, sf_dir))
    ingest.stream_sink(clean, path, scratch_path(spark, "checkpoint"), partition_by=["event_type"]).awaitTermination()
    return event_output(spark.read.parquet(path))


@query(
    "stream_dedup",
    f"""WITH {sql.FLAWED} SELECT DISTINCT event_id FROM flawed WHERE {sql.MANDATORY} AND {sql.PLAUSIBLE}""",
)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy arrives first is open, so only the surviving ids are returned.

    Ship dates come in no order, so no watermark holds: ids meet in keyed state, whatever file or micro-batch has them.
    """
    path = scratch_path(spark, "stream_deduped")
    clean = ingest.clean_stream(flawed_stream(spark, sf_dir))
    ingest.stream_distinct(clean, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).select("event_id")


@query(
    "stream_dead_letter",
    f"""WITH {sql.FLAWED}, tagged AS (SELECT *, concat_ws('|',
            CASE WHEN event_id IS NULL THEN 'event_id_missing' END,
            CASE WHEN customer_id IS NULL THEN 'customer_id_missing' END,
            CASE WHEN timestamp IS NULL THEN 'timestamp_missing' END,
            CASE WHEN revenue < 0 THEN 'revenue_negative' END,
            CASE WHEN quantity < 0 THEN 'quantity_negative' END) AS reasons FROM flawed),
        split AS (SELECT * REPLACE (CASE WHEN reasons = '' THEN coalesce(date, strftime(timestamp, '%Y-%m-%d')) ELSE date END
                                    AS date) FROM tagged)
        SELECT {sql.EVENT_OUT}, reasons FROM split""",
)
def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables read back together; valid rows have no reasons."""
    good, dead = scratch_path(spark, "stream_valid"), scratch_path(spark, "stream_dead")
    query_run = ingest.stream_with_dead_letters(
        flawed_stream(spark, sf_dir), good, dead, scratch_path(spark, "checkpoint"), partition_by=["region"]
    )
    query_run.awaitTermination()
    valid = event_output(spark.read.parquet(good)).withColumn("reasons", F.lit(""))
    rejected = spark.read.parquet(dead)
    return valid.unionByName(event_output(rejected, joined("reasons").alias("reasons")))
