"""Structured Streaming ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from brightwater.operators.quality import add_partition_date, filter_quality, reject_reasons
from brightwater.operators.tables import overwrite
from brightwater.schema import EVENT_SCHEMA, PARTITION_COLUMNS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA, max_files_per_trigger: int = 100
) -> DataFrame:
    """New Parquet files as they arrive, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep deduplication state on disk instead of in the executors' heap.

    The checkpoint gets a batch's changes rather than a copy of all state.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def dedup_first(events: DataFrame, delay: str = "1 day", key: str = "event_id", ts: str = "timestamp") -> DataFrame:
    """Keep the first arrival of a key within the watermark delay.

    Rows later than the delay are dropped, copies or not; :func:`stream_distinct` keeps them.
    Latest-wins needs later rows to replace earlier ones; apply
    :func:`brightwater.operators.quality.dedup_latest` when the sink is read.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def clean_stream(events: DataFrame, dedup_delay: str | None = None) -> DataFrame:
    """Quality filters, optional deduplication, row-wise partition date."""
    kept = filter_quality(events)
    if dedup_delay:
        kept = dedup_first(kept, dedup_delay)
    return add_partition_date(kept, mode="fill")


def stream_distinct(clean: DataFrame, path: str, checkpoint: str, key: str = "event_id", fmt: str = "parquet") -> StreamingQuery:
    """Append the first arrival of each key, however late a row comes, then stop.

    The keys seen are keyed state without watermark or end, in RocksDB on the executors' disks with its
    changes in the checkpoint, so a micro-batch costs what its own rows cost and never reads the sink. Equal
    keys of a batch meet as a stream, none is held; state grows by one entry per distinct key. Where the disorder of the
    input is known, :func:`dedup_first` forgets keys after a delay. Each batch writes the folder of its
    own number, so a batch replayed after a failure replaces itself. A null key is a key like any other. Sets the
    session's state store, see :func:`use_rocksdb_state`; the number of shuffle partitions is fixed by the first run.
    """

    def write(batch: DataFrame, number: int) -> None:
        overwrite(batch, f"{path.rstrip('/')}/batch={number}", None, fmt)

    use_rocksdb_state(clean.sparkSession)
    return (
        clean.dropDuplicates([key])
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_sink(
    clean: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = PARTITION_COLUMNS,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append what has arrived to a partitioned table, then stop.

    The checkpoint and the file sink's commit log make a restart exactly-once.
    """
    writer = clean.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def stream_ingest(
    events: DataFrame, path: str, checkpoint: str, dedup_delay: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    return stream_sink(clean_stream(events, dedup_delay), path, checkpoint, fmt=fmt)


def stream_with_dead_letters(
    events: DataFrame,
    path: str,
    dead_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = PARTITION_COLUMNS,
) -> StreamingQuery:
    """Valid rows to one table and rejected rows with reasons to another, both in the main sink's layout.

    Each micro-batch overwrites the folder of its own batch number, so a batch
    replayed after a failure replaces itself and nothing is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        tagged = batch.withColumn("reasons", reject_reasons(batch)).persist()
        try:
            valid = add_partition_date(tagged.filter(F.size("reasons") == 0).drop("reasons"), mode="fill")
            rejected = tagged.filter(F.size("reasons") > 0)
            for rows, target in ((valid, path), (rejected, dead_path)):
                overwrite(rows, f"{target.rstrip('/')}/batch={number}", partition_by, fmt)
        finally:
            tagged.unpersist()

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
