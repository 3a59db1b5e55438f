from __future__ import annotations

import datetime as dt
import fnmatch

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightwater.functions.keys import glob_regex, payload_json, score_key
from brightwater.operators import monitor, store

NOW = dt.datetime(2024, 1, 1, 12)


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), store.STORE_SCHEMA)


def test_payload_text_and_key_order(spark):
    df = spark.createDataFrame([(1, 'say "hi"', None)], "b int, a string, c double")
    assert df.select(payload_json(["b", "a", "c"])).head()[0] == '{"a": "say \\"hi\\"", "b": 1, "c": null}'
    one, two = df.select(score_key("churn", ["a", "b"]), score_key("churn", ["b", "a"])).head()
    assert one == two and one.startswith("churn:") and len(one) == len("churn:") + 16


def test_key_tells_null_from_the_word(spark):
    df = spark.createDataFrame([(None,), ("null",)], "a string")
    assert df.select(score_key("k", ["a"])).distinct().count() == 2


def test_lookup_respects_the_time_to_live(spark):
    table = entries(
        spark,
        ("live", "1", NOW - dt.timedelta(seconds=299), 300),
        ("old", "2", NOW - dt.timedelta(seconds=300), 300),
    )
    asked = spark.createDataFrame([("live",), ("old",), ("new",), ("live",)], "key string")
    found = store.score_lookup(asked, table, NOW)
    assert sorted((r.key, r.cached) for r in found.collect()) == [
        ("live", True),
        ("live", True),
        ("new", False),
        ("old", False),
    ]
    assert store.hit_rate(found).head().asDict() == {"hits": 2, "misses": 2, "hit_rate": 0.5}
    assert store.hit_rate(found.limit(0)).head().hit_rate == 0.0


def test_put_delete_and_default_ttl(spark):
    table = entries(spark, ("a", "1", NOW, 5), ("b", "2", NOW, 5))
    fresh = spark.createDataFrame([("b", "3")], "key string, value string")
    after = store.score_put(table, store.store_entries(fresh, NOW, ttl_seconds=0))
    assert {r.key: (r.value, r.ttl_seconds) for r in after.collect()} == {"a": ("1", 5), "b": ("3", 300)}
    gone = store.score_delete(after, spark.createDataFrame([("a",)], "key string"))
    assert [r.key for r in gone.collect()] == ["b"]


def test_invalidate_by_glob(spark):
    table = entries(spark, *[(k, "v", NOW, 5) for k in ("churn:1", "churn:2", "nlp:1")])
    left, removed = store.score_invalidate(table, "churn:*")
    assert [r.key for r in left.collect()] == ["nlp:1"] and removed.head().removed == 2


@settings(max_examples=60, deadline=None)
@given(st.text("ab*?.[]x", max_size=6), st.text("ab.x", max_size=5))
def test_globs_match_like_shell_patterns(pattern, key):
    import re

    if "[" in pattern:
        return
    assert bool(re.match(glob_regex(pattern), key)) == fnmatch.fnmatchcase(key, pattern)


def test_scoring_with_the_store_scores_each_payload_once(spark):
    asked = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "id int, x int")
    known = asked.filter("x = 20").select(score_key("churn", ["x"]).alias("key"))
    table = known.select(
        "key", F.lit('{"prediction":0.0,"churn_probability":0.12}').alias("value"), F.lit(NOW).alias("written_at"), F.lit(300).alias("ttl_seconds")
    )
    counted = []

    def score(misses):
        counted.append(misses.count())
        return misses.withColumns({"prediction": F.lit(1.0), "churn_probability": F.col("x") / 100.0})

    answers, after = store.score_with_store(asked, table, ["x"], score, ["prediction", "churn_probability"], as_of=NOW)
    got = {r.id: (r.prediction, r.churn_probability, r.cached) for r in answers.collect()}
    assert got == {1: (1.0, 0.1, False), 2: (1.0, 0.1, False), 3: (0.0, 0.12, True), 4: (1.0, 0.3, False)}
    assert counted == [2]
    again, _ = store.score_with_store(asked, after, ["x"], score, ["prediction", "churn_probability"], as_of=NOW)
    assert all(r.cached for r in again.collect())


def log(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_counters_default_to_unknown(spark):
    rows = log(spark, [("m", "1"), ("m", None), ("m", None)], "model_name string, label string")
    assert {r.label: r.predictions for r in monitor.predictions_total(rows).collect()} == {"1": 1, "unknown": 2}


def test_histogram_is_cumulative(spark):
    rows = log(spark, [("m", 0.005), ("m", 0.2), ("m", 9.0), ("m", None)], "model_name string, latency_seconds double")
    out = {r.le: r.cumulative for r in monitor.latency_histogram(rows).collect()}
    assert out["0.005"] == 1 and out["0.25"] == 2 and out["2.5"] == 2 and out["+Inf"] == 3 and len(out) == 10


def test_gauges_take_the_latest_value(spark):
    rows = log(spark, [("m", 0.9, NOW), ("m", 0.8, NOW + dt.timedelta(1)), ("m", None, NOW + dt.timedelta(2))], "model_name string, accuracy double, ts timestamp")
    out = monitor.accuracy_gauge(rows).head()
    assert (out.accuracy, out.alert) == (0.8, True)


def sample(spark, values, schema="x double"):
    return spark.createDataFrame([(v,) for v in values], schema)


def psi(spark, base, current):
    return monitor.psi_drift(sample(spark, base), sample(spark, current), ["x"]).head().psi


def test_psi(spark):
    base = [float(i) for i in range(200)]
    assert psi(spark, base, base) == pytest.approx(0)
    assert psi(spark, base, [v + 100 for v in base]) > monitor.DRIFT_ALERT
    shares = [0.1] * 10
    moved = [1e-4] * 5 + [0.1, 0.1, 0.1, 0.1, 0.6]
    import math

    want = sum((a - e) * math.log(a / e) for a, e in zip(moved, shares))
    assert psi(spark, base, [v + 100 for v in base]) == pytest.approx(want, rel=1e-6)


def test_psi_of_constant_and_missing_features(spark):
    assert psi(spark, [5.0] * 10, [5.0] * 3) == pytest.approx(0)
    assert psi(spark, [5.0] * 10, [None, float("nan"), 9.0]) > 1
    alert = monitor.drift_alert(monitor.psi_drift(sample(spark, [1.0, 2.0]), sample(spark, [1.0, 2.0]), ["x"]))
    assert alert.count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 9), min_size=3, max_size=25), st.lists(st.integers(0, 9), min_size=3, max_size=25))
def test_psi_agrees_with_plain_arithmetic(spark, base, current):
    import bisect
    import math

    import numpy as np

    cuts = sorted(set(np.quantile(base, [i / 10 for i in range(1, 10)]).tolist()))

    def shares(values):
        bins = [0] * (len(cuts) + 1)
        for v in values:
            bins[bisect.bisect_left(cuts, v)] += 1
        return [max(n / len(values), 1e-4) for n in bins]

    want = sum((a - e) * math.log(a / e) for a, e in zip(shares(current), shares(base)))
    assert psi(spark, [float(v) for v in base], [float(v) for v in current]) == pytest.approx(want, abs=1e-9)
