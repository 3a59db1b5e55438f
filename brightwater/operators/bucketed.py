"""A score store kept by buckets of the key, so that lookups and updates never shuffle what is stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.operators.features import AsOf
from brightwater.operators.store import STORE_SCHEMA, live_entries
from brightwater.operators.tables import exists, upsert
from brightwater.session import written

# ``insertInto`` knows no option for it.
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
COLUMNS = [field.split(" ")[0] for field in STORE_SCHEMA.split(", ")]


@dataclass(frozen=True)
class BucketedStore:
    """A Parquet table bucketed by ``key`` into ``buckets`` files and partitioned by ``shard``, another hash of it.

    A lookup joins on the buckets as they lie; an update rewrites the shards its keys fall in. Choose ``buckets`` no
    fewer than the session's shuffle partitions, otherwise Spark may shuffle both sides for more tasks. One writer at a
    time; an update replaces whole shards at its commit.
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int
    shards: int

    def rows(self) -> DataFrame:
        """The whole store: (key, value, written_at, ttl_seconds)."""
        return self.spark.table(self.name).select(*COLUMNS)

    def shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def lookup(self, requests: DataFrame, as_of: AsOf = None) -> DataFrame:
        """Requests with ``value`` and ``cached`` as :func:`brightwater.operators.store.score_lookup` gives them.

        The distinct keys asked for are combined before their shuffle and meet the store in its buckets; requests
        meet what was found, whose hot keys the adaptive skew join splits. A null key finds nothing.
        """
        asked = requests.select("key").where("key IS NOT NULL").distinct()
        found = live_entries(self.rows(), as_of).join(asked.hint("merge"), "key").select("key", "value")
        return requests.join(found, "key", "left").withColumn("cached", F.col("value").isNotNull())

    def put(self, entries: DataFrame) -> None:
        """Insert or replace by key; ``entries`` must hold a key once and must not be read from this store.

        Shards without an entry are neither read nor written. A null key is an error.
        """
        known = entries.select(F.coalesce("key", F.raise_error(F.lit("a store key is null"))).alias("key"), *COLUMNS[1:])
        # At most ``shards`` numbers reach the driver.
        touched = sorted(r.shard for r in known.select(self.shard().alias("shard")).distinct().collect())
        if touched:
            self._replace(touched, lambda kept: upsert(kept, known, ["key"]))

    def delete(self, keys: DataFrame) -> None:
        """Remove the keys; shards without one are neither read nor written."""
        asked = keys.select("key").where("key IS NOT NULL").distinct()
        touched = sorted(r.shard for r in asked.select(self.shard().alias("shard")).distinct().collect())
        if touched:
            self._replace(touched, lambda kept: kept.join(asked.hint("merge"), "key", "left_anti"))

    def expire(self, as_of: AsOf = None) -> None:
        """Remove what is past its time to live: the whole store is rewritten."""
        self._replace(list(range(self.shards)), lambda kept: live_entries(kept, as_of))

    def _replace(self, shards: list[int], change) -> None:
        kept = self.spark.table(self.name).where(F.col("shard").isin(shards)).select(*COLUMNS)
        self._write(change(kept), shards)

    def _write(self, rows: DataFrame, shards: list[int]) -> None:
        # The partitioner is the one of the buckets: a task writes one file a shard. A shard left without rows
        # is not among the written ones, so it is emptied by name. The rows are written once beside the store first,
        # so that a job that fails while it replaces shards has lost none of them.
        laid = written(rows.select(*COLUMNS, self.shard().alias("shard")), "store-shards")
        mode = self.spark.conf.get(OVERWRITE_MODE, None)
        self.spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            laid.repartition(self.buckets, "key").write.insertInto(self.name, overwrite=True)
            left = {r.shard for r in laid.select("shard").distinct().collect()}
            for shard in sorted(set(shards) - left):
                nothing = laid.where("false").select(*COLUMNS)
                self.spark.sql(f"INSERT OVERWRITE {self.name} PARTITION (shard = {shard}) SELECT * FROM {{nothing}}", nothing=nothing)
        finally:
            if mode is None:
                self.spark.conf.unset(OVERWRITE_MODE)
            else:
                self.spark.conf.set(OVERWRITE_MODE, mode)
        self.spark.catalog.refreshTable(self.name)


def open_store(spark: SparkSession, path: str, name: str, buckets: int = 256, shards: int = 64) -> BucketedStore:
    """The store at ``path`` under a table name of the session; made empty where there is none.

    ``buckets`` and ``shards`` are fixed by the first call for a path and must be given alike later.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({STORE_SCHEMA}, shard int) USING parquet "
        f"PARTITIONED BY (shard) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if exists(spark, path):
        spark.catalog.recoverPartitions(name)
    return BucketedStore(spark, name, path, buckets, shards)
