from __future__ import annotations

import datetime as dt
from functools import partial

from compare import duck
from test_quality import T1, T2, event, frame

from brightwater import plans
from brightwater.operators.quality import add_partition_date, filter_quality
from brightwater.streaming import ingest


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=str)


def land(spark, path, *batches):
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


BATCHES = [
    [event("a"), event("b", revenue=-1.0), event(None)],
    [event("c", ts=T2, date="1999-01-01"), event("d", ts=None), event("a", ts=T2)],
]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    land(spark, source, BATCHES[0])

    def run():
        stream = ingest.stream_parquet(spark, source, max_files_per_trigger=1)
        ingest.stream_ingest(stream, sink, checkpoint).awaitTermination()

    run()
    run()
    land(spark, source, BATCHES[1])
    run()
    everything = frame(spark, BATCHES[0] + BATCHES[1])
    want = add_partition_date(filter_quality(everything), mode="fill")
    got = spark.read.schema(want.schema).parquet(sink)
    assert rows_of(got) == rows_of(want)
    assert (tmp_path / "out" / "date=2024-01-01" / "region=EU").exists()


def test_first_arrival_wins_within_the_watermark(spark, tmp_path):
    ingest.use_rocksdb_state(spark)
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    land(spark, source, [event("a", product="first"), event("b")])
    for late in (None, [event("a", ts=T1 + dt.timedelta(hours=1), product="second"), event("c")]):
        if late:
            land(spark, source, late)
        stream = ingest.stream_parquet(spark, source, max_files_per_trigger=1)
        ingest.stream_ingest(stream, sink, checkpoint, dedup_delay="2 days").awaitTermination()
    kept = {r.event_id: r.product_id for r in spark.read.parquet(sink).collect()}
    assert kept == {"a": "first", "b": "p1", "c": "p1"}


def test_rejected_rows_go_to_their_own_table_once(spark, tmp_path):
    source, good, dead, checkpoint = (str(tmp_path / n) for n in ("in", "good", "dead", "checkpoint"))
    land(spark, source, *BATCHES)
    for _ in range(2):
        stream = ingest.stream_parquet(spark, source, max_files_per_trigger=1)
        ingest.stream_with_dead_letters(stream, good, dead, checkpoint).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(good).collect()) == ["a", "a", "c"]
    reasons = sorted(tuple(r.reasons) for r in spark.read.parquet(dead).collect())
    assert reasons == [("event_id_missing",), ("revenue_negative",), ("timestamp_missing",)]


def test_distinct_ids_of_many_files_in_no_time_order(spark, sf_dir, tmp_path, monkeypatch):
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for k in (0, 1, 2, 0):
        line.where(f"l_orderkey % 3 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(ingest, "stream_parquet", partial(ingest.stream_parquet, max_files_per_trigger=1))
    got = sorted(r.event_id for r in plans.all_queries()["stream_dedup"](spark, str(tmp_path)).collect())
    assert got == sorted(r[0] for r in duck(sf_dir).execute(plans.all_oracles()["stream_dedup"]).fetchall())


def test_distinct_resumes_and_replays_a_batch(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = ingest.stream_parquet(spark, source, max_files_per_trigger=1)
        ingest.stream_distinct(stream, sink, checkpoint).awaitTermination()
        return sorted(((r.event_id or ""), r.product_id) for r in spark.read.parquet(sink).collect())

    land(spark, source, [event("a", ts=T2, product="first"), event("b"), event("b"), event(None)])
    run()
    land(spark, source, [event("a", product="second"), event("c", ts=T1 - dt.timedelta(days=900)), event(None)])
    want = [("", "p1"), ("a", "first"), ("b", "p1"), ("c", "p1")]
    assert run() == want
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert run() == want
    land(spark, source, [event("b", product="third")])
    assert run() == want


def test_distinct_keeps_keys_in_state_and_never_reads_the_sink(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for round_ in range(3):
        land(spark, source, [event(f"{round_}-{i}") for i in range(20)] + [event("0-1"), event("0-2")])
        stream = ingest.stream_parquet(spark, source, max_files_per_trigger=1)
        run = ingest.stream_distinct(stream, sink, checkpoint)
        run.awaitTermination()
    (state,) = [p["stateOperators"][0] for p in [run.recentProgress[-1]]]
    assert state["numRowsTotal"] == 60 and "rocksdb" in str(state["customMetrics"]).lower()
    assert "out" not in [s["description"].split("/")[-1].rstrip("]") for s in run.recentProgress[-1]["sources"]]
    assert spark.read.parquet(sink).count() == 60
