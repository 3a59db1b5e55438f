from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brightwater.operators import quality
from brightwater.schema import EVENT_SCHEMA
from brightwater.sources import files

T1, T2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)


def event(event_id="e1", customer="c1", ts=T1, quantity=1, revenue=1.0, date=None, region="EU", product="p1"):
    return (event_id, customer, "purchase", region, product, quantity, revenue, 60, ts, date)


def frame(spark, rows):
    from pyspark.sql import types as T

    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in EVENT_SCHEMA.fields])
    return spark.createDataFrame(rows, nullable)


def ids(df):
    return sorted(r.event_id or "" for r in df.collect())


def test_quality_filters_keep_null_and_nan_amounts(spark):
    rows = [
        event("ok"),
        event(None),
        event("no-customer", None),
        event("no-time", ts=None),
        event("negative", revenue=-1.0),
        event("null-revenue", revenue=None),
        event("nan", revenue=float("nan")),
        event("negative-quantity", quantity=-1),
        event("null-quantity", quantity=None),
    ]
    assert ids(quality.filter_quality(frame(spark, rows))) == ["nan", "null-quantity", "null-revenue", "ok"]


def test_dedup_keeps_ties_of_the_latest_instant(spark):
    rows = [event("a", ts=T1), event("a", ts=T2, product="x"), event("a", ts=T2, product="y"), event("b")]
    kept = quality.dedup_latest(frame(spark, rows))
    assert sorted((r.event_id, r.product_id) for r in kept.collect()) == [("a", "x"), ("a", "y"), ("b", "p1")]
    one = quality.dedup_latest(frame(spark, rows), ties="one", tie_break=["product_id"])
    assert sorted((r.event_id, r.product_id) for r in one.collect()) == [("a", "y"), ("b", "p1")]
    gone = quality.superseded(frame(spark, rows))
    assert [(r.event_id, r.timestamp) for r in gone.collect()] == [("a", T1)]


def test_dedup_treats_null_keys_and_times_as_a_rank_would(spark):
    rows = [event(None, ts=T1), event(None, ts=T2), event("n", ts=None), event("n", ts=None)]
    kept = quality.dedup_latest(frame(spark, rows)).collect()
    assert sorted((r.event_id or "", r.timestamp or T1) for r in kept) == [("", T2), ("n", T1), ("n", T1)]


def test_dedup_rejects_unknown_tie_rule(spark):
    with pytest.raises(ValueError):
        quality.dedup_latest(frame(spark, [event()]), ties="any")


def test_one_null_date_rewrites_every_date(spark):
    rows = [event("a", date="1999-01-01"), event("b", ts=T2, date=None)]
    dates = {r.event_id: r.date for r in quality.add_partition_date(frame(spark, rows)).collect()}
    assert dates == {"a": "2024-01-01", "b": "2024-01-02"}
    filled = {r.event_id: r.date for r in quality.add_partition_date(frame(spark, rows), mode="fill").collect()}
    assert filled == {"a": "1999-01-01", "b": "2024-01-02"}
    complete = quality.add_partition_date(frame(spark, rows[:1]))
    assert complete.head().date == "1999-01-01"
    derived = quality.add_partition_date(frame(spark, rows[:1]).drop("date"))
    assert derived.head().date == "2024-01-01"


def test_stats_agree_with_the_cleaned_frame(spark):
    rows = [event("a", ts=T1), event("a", ts=T2), event("a", ts=T2), event("b", revenue=-5.0), event(None), event("c")]
    rows += [event("d", ts=T1), event("d", ts=T2, quantity=-1)]
    raw = frame(spark, rows)
    stats = quality.ingestion_stats(raw, "test").head()
    assert stats.records_read == 8
    assert stats.records_valid == quality.clean_events(raw).count() == 4
    assert stats.records_rejected == 4 == quality.dead_letter(raw).count()
    assert stats.reliability == 0.5
    alert = quality.reliability_alert(quality.ingestion_stats(raw)).head()
    assert alert.below_target


def test_stats_of_nothing(spark):
    stats = quality.ingestion_stats(frame(spark, [])).head()
    assert (stats.records_read, stats.records_valid, stats.reliability) == (0, 0, 0.0)


def test_dead_letter_reasons(spark):
    rows = [event(None, None, revenue=-1.0), event("a", ts=T1), event("a", ts=T2)]
    reasons = sorted(tuple(r.reasons) for r in quality.dead_letter(frame(spark, rows)).collect())
    assert reasons == [("event_id_missing", "customer_id_missing", "revenue_negative"), ("superseded_duplicate",)]


def test_observed_ingest_counts_while_writing(spark, tmp_path):
    rows = [event("a", ts=T1), event("a", ts=T2), event("b", revenue=-5.0), event("c", date="2020-01-01")]
    source = str(tmp_path / "in")
    frame(spark, rows).write.parquet(source)
    clean, seen, kept = files.ingest_observed(files.read_parquet(spark, source), "run")
    clean.write.parquet(str(tmp_path / "out"))
    stats = files.stats_from_observations("run", seen, kept)
    assert (stats["records_read"], stats["records_valid"], stats["records_rejected"]) == (4, 2, 2)


def test_json_dead_letters_keep_bad_lines(spark, tmp_path):
    lines = [
        json.dumps({"event_id": "a", "customer_id": "c", "timestamp": "2024-01-01T10:00:00"}),
        '{"event_id": "b", "customer_id": "c", "timestamp": "2024-01-01T10:00:00", "quantity": "many"}',
        "not json at all",
    ]
    path = tmp_path / "events.json"
    path.write_text("\n".join(lines))
    raw = files.read_json(spark, str(path), keep_corrupt=True)
    dead = quality.dead_letter(raw.cache()).collect()
    assert sorted(r._corrupt for r in dead) == sorted(lines[1:])
    assert all("corrupt_record" in r.reasons for r in dead)
    assert ids(files.ingest_json(spark, str(path)))[-1] == "b"


def test_cast_errors_reach_the_dead_letter(spark):
    raw = spark.createDataFrame(
        [("1", "c", "2024-01-01 00:00:00", "3"), ("2", "c", "2024-01-01 00:00:00", "three")],
        "event_id string, customer_id string, timestamp string, quantity string",
    )
    shaped = files.enforce_schema(raw, keep_errors=True)
    assert shaped.drop("_cast_errors").columns == EVENT_SCHEMA.names
    dead = quality.dead_letter(shaped).collect()
    assert [(r.event_id, r.reasons) for r in dead] == [("2", ["type_mismatch"])]


def test_hot_key_is_split_by_the_skew_join(spark):
    """A third of the rows share one id at one instant: the join must cut that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
            F.lit(T1).alias("timestamp"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        kept = quality.dedup_latest(rows)
        assert len(kept.filter("event_id = 'hot'").collect()) == 100_000
        result = kept.selectExpr("count(payload) AS n", "max(payload) AS m")
        assert result.collect()[0].n == 300_000
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_per_key_is_trimmed_before_the_shuffle(spark):
    plan = quality.dedup_latest(frame(spark, [event()]), ties="one")._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange hashpartitioning(event_id", 1)[1]
    assert "WindowGroupLimit" in below_shuffle


def test_the_date_test_does_not_deduplicate_again(spark, tmp_path):
    path = str(tmp_path / "events")
    frame(spark, [event("a", date="2024-01-01")]).write.parquet(path)
    plan = files.ingest_parquet(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and plan.count("Join LeftSemi") == 1


def test_clean_and_dead_rows_are_all_rows(spark):
    rows = [("a", 1, None), ("a", 2, None), ("b", 1, "{bad"), (None, 1, None), ("c", 1, None), ("c", 1, None)]
    df = spark.createDataFrame(rows, "event_id string, at int, _corrupt string").select(
        "event_id",
        F.lit("u").alias("customer_id"),
        F.timestamp_seconds("at").alias("timestamp"),
        F.lit(1.0).alias("revenue"),
        F.lit(1).alias("quantity"),
        F.lit(None).cast("string").alias("date"),
        "_corrupt",
    )
    clean, dead = quality.clean_events(df), quality.dead_letter(df)
    assert (clean.count(), dead.count()) == (3, 3)
    assert quality.ingestion_stats(df).head().records_valid == 3
    assert all(r.date for r in clean.collect())


def test_one_undated_survivor_dates_all_rows_anew(spark):
    rows = [("a", 1, None), ("a", 2, "old"), ("b", 1, "kept")]
    df = spark.createDataFrame(rows, "event_id string, at int, date string").select(
        "event_id", F.lit("u").alias("customer_id"), F.timestamp_seconds("at").alias("timestamp"), F.lit(1.0).alias("revenue"), F.lit(1).alias("quantity"), "date"
    )
    # The undated row is superseded, so no survivor lacks a date.
    assert sorted(r.date for r in quality.clean_events(df).collect()) == ["kept", "old"]
    undated = df.unionByName(df.where("event_id = 'b'").withColumns({"event_id": F.lit("c"), "date": F.lit(None).cast("string")}))
    assert {r.date for r in quality.clean_events(undated).collect()} == {"1970-01-01"}


def test_ingestion_hashes_its_aggregates(spark, tmp_path):
    path = str(tmp_path / "in")
    frame(spark, [event("a"), event("b")]).write.parquet(path)
    plan = files.ingest_parquet(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_dead_letter_reads_its_source_twice(spark, tmp_path):
    rows = spark.range(30).selectExpr(
        "IF(id % 3 = 0, NULL, concat('e', id % 4)) event_id", "'c' customer_id", "timestamp_seconds(id) timestamp", "1.0 revenue", "1 quantity"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    dead = quality.dead_letter(spark.read.parquet(str(tmp_path / "rows")))
    assert dead._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    got = {tuple(r.reasons): r["count"] for r in dead.groupBy("reasons").count().collect()}
    # Twenty rows have a key, the latest of each of four stays.
    assert got == {("event_id_missing",): 10, ("superseded_duplicate",): 16}


def test_json_input_is_written_compressed(spark, sf_dir, tmp_path, monkeypatch):
    from brightwater.plans import ingest

    monkeypatch.setattr(ingest, "scratch_path", lambda spark, name: str(tmp_path / name))
    ingest.ingest_json(spark, sf_dir)
    assert list(tmp_path.glob("events_json/*.json.gz")) and not list(tmp_path.glob("events_json/*.json"))
