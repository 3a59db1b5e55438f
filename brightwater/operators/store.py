"""Score store: a keyed table of earlier results with a time to live.

Columns: ``key``, ``value`` (JSON text), ``written_at``, ``ttl_seconds``; one row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightwater.functions.keys import glob_regex, score_key
from brightwater.operators.features import AsOf, as_of_column
from brightwater.operators.tables import upsert
from brightwater.session import written

DEFAULT_TTL_SECONDS = 300
STORE_SCHEMA = "key string, value string, written_at timestamp, ttl_seconds int"


def _live(now: Column) -> Column:
    return F.timestamp_add("SECOND", F.col("ttl_seconds"), F.col("written_at")) > now


def live_entries(store: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The store without what is past its time to live."""
    return store.filter(_live(as_of_column(as_of)))


def score_lookup(requests: DataFrame, store: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every request with the live stored ``value``, if any, and a ``cached`` flag.

    The store holds a key once, so a key asked for by a third of the requests
    only enlarges the side the adaptive skew join splits.
    """
    live = live_entries(store, as_of).select("key", F.col("value"))
    return requests.join(live, "key", "left").withColumn("cached", F.col("value").isNotNull())


def store_entries(scored: DataFrame, as_of: AsOf = None, ttl_seconds: int | None = None) -> DataFrame:
    """(key, value) rows as store rows; a missing or zero TTL means the default."""
    return scored.select(
        "key",
        "value",
        as_of_column(as_of).alias("written_at"),
        F.lit(ttl_seconds or DEFAULT_TTL_SECONDS).cast("int").alias("ttl_seconds"),
    )


def score_put(store: DataFrame, entries: DataFrame) -> DataFrame:
    return upsert(store, entries, ["key"])


def score_delete(store: DataFrame, keys: DataFrame) -> DataFrame:
    return store.join(keys.select("key"), "key", "left_anti")


def score_invalidate(store: DataFrame, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(remaining store, one row with the number of keys removed)."""
    hit = F.col("key").rlike(glob_regex(pattern))
    return store.filter(~hit), store.filter(hit).agg(F.count(F.lit(1)).alias("removed"))


def hit_rate(looked_up: DataFrame) -> DataFrame:
    hits, total = F.count_if("cached"), F.count(F.lit(1))
    return looked_up.agg(
        hits.alias("hits"),
        F.count_if(~F.col("cached")).alias("misses"),
        F.coalesce(F.round(F.try_divide(hits, total), 4), F.lit(0.0)).alias("hit_rate"),
    )


def score_with_store(
    requests: DataFrame,
    store: DataFrame,
    columns: list[str],
    score: Callable[[DataFrame], DataFrame],
    outputs: list[str],
    prefix: str = "churn",
    as_of: AsOf = None,
    ttl_seconds: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Answer from the store where possible and score the rest.

    Returns (answers, store after the write-back). Each distinct payload that
    misses is scored once, however many requests carry it. ``score`` gets the
    payload columns and adds ``outputs``, of any type that JSON holds; answers carry those, in the
    scorer's types, and ``cached``. The lookup and the fresh scores are written to the
    shared folder, so that both frames read what was joined and scored once.
    """
    keyed = requests.withColumn("key", score_key(prefix, columns))
    looked_up = written(score_lookup(keyed, store, as_of), "looked-up")
    misses = looked_up.filter(~F.col("cached")).select("key", *columns).dropDuplicates(["key"])
    scored = score(misses).select("key", *outputs)
    kinds = StructType([f for f in scored.schema if f.name in outputs])
    fresh = scored.select("key", F.to_json(F.struct(*outputs), {"ignoreNullFields": "false"}).alias("value"))
    fresh = written(fresh, "fresh-scores")
    answers = looked_up.join(fresh.withColumnRenamed("value", "_fresh"), "key", "left")
    answers = answers.withColumn("_v", F.from_json(F.coalesce("value", "_fresh"), kinds))
    answers = answers.select(*requests.columns, *[F.col("_v")[c].alias(c) for c in outputs], "cached")
    return answers, score_put(store, store_entries(fresh, as_of, ttl_seconds))
