"""The bucketed score store: lookups without a shuffle of the store, updates of touched shards only."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brightwater.operators import store
from brightwater.operators.bucketed import open_store

NOW = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def kept(spark, tmp_path):
    return open_store(spark, f"file:{tmp_path}/scores", "scores_" + tmp_path.name.replace("-", "_"), buckets=16, shards=8)


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), store.STORE_SCHEMA)


def many(spark, count, value="1"):
    keys = spark.range(count).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.lit(value).alias("value"))
    return store.store_entries(keys, NOW)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_store_side_has_no_exchange(spark, kept):
    kept.put(many(spark, 500))
    asked = spark.range(1000).selectExpr("concat('k', id % 700) key", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = kept.lookup(asked, NOW)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    assert "Bucketed: true" in lines[scan]
    above = next(lines[i] for i in range(scan, -1, -1) if "Exchange" in lines[i] or "SortMergeJoin" in lines[i])
    assert "SortMergeJoin" in above
    assert found.where("cached").count() == 800
    plain = store.score_lookup(asked, kept.rows(), NOW)
    assert found.exceptAll(plain.select(*found.columns)).count() == 0 and found.count() == plain.count()


def test_only_touched_shards_are_rewritten(spark, kept, tmp_path):
    kept.put(many(spark, 500))
    before = files(tmp_path)
    kept.put(entries(spark, ("k3", "2", NOW, 60)))
    after = files(tmp_path)
    gone = {os.path.basename(os.path.dirname(f)) for f in before - after}
    assert len(gone) == 1 and len(before & after) > 0
    assert {os.path.basename(os.path.dirname(f)) for f in after - before} == gone
    assert kept.rows().count() == 500
    assert kept.rows().where("key = 'k3'").first().value == "2"


def test_delete_expire_and_empty_shards(spark, kept):
    assert kept.rows().count() == 0
    kept.put(entries(spark, ("a", "1", NOW, 60), ("b", "2", NOW, 600)))
    kept.delete(spark.createDataFrame([("a",), (None,), ("nowhere",)], "key string"))
    assert [r.key for r in kept.rows().collect()] == ["b"]
    kept.put(entries(spark, ("c", "3", NOW, 60)))
    kept.expire(NOW + dt.timedelta(seconds=60))
    assert [r.key for r in kept.rows().collect()] == ["b"]
    kept.put(many(spark, 0))
    kept.delete(spark.createDataFrame([], "key string"))
    assert kept.rows().count() == 1


def test_nulls_and_reopening(spark, kept, tmp_path):
    kept.put(entries(spark, ("a", None, NOW, 60)))
    asked = spark.createDataFrame([("a",), (None,), ("x",)], "key string")
    assert [r.cached for r in kept.lookup(asked, NOW).collect()] == [False] * 3
    with pytest.raises(Exception, match="a store key is null"):
        kept.put(entries(spark, (None, "1", NOW, 60)))
    again = open_store(spark, kept.path, kept.name + "_again", buckets=16, shards=8)
    assert [r.key for r in again.rows().collect()] == ["a"]
