from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_quality import event, frame

from brightwater.functions import contracts
from brightwater.operators import features as fx

DAY = dt.datetime(2024, 1, 1)


def at(days):
    return DAY + dt.timedelta(days=days)


def test_customer_features_groups_and_scores(spark):
    rows = [
        event("1", ts=at(0), revenue=10.0),
        event("2", ts=at(0), revenue=None, product=None),
        event("3", ts=at(5), revenue=20.0),
        event("4", region=None, ts=at(5), revenue=1.0),
    ]
    out = {r.region: r for r in fx.customer_features(frame(spark, rows), as_of="2024-01-11").collect()}
    assert set(out) == {"EU", None}
    eu = out["EU"]
    assert (eu.total_events, eu.unique_products, eu.total_revenue, eu.avg_order_value) == (3, 1, 30.0, 15.0)
    assert (eu.active_days, eu.days_since_last_event, eu.customer_tenure_days) == (2, 5, 10)
    assert eu.recency_score == pytest.approx(1 - 5 / 180)
    assert eu.engagement_score == pytest.approx(0.4 * eu.recency_score + 0.3 * 2 / 90 + 0.3 * 0.03)


def test_future_events_exceed_one_unless_capped(spark):
    rows = [event(str(i), ts=at(i)) for i in range(100)]
    base = fx.customer_features(frame(spark, rows), as_of="2023-01-01").head()
    assert base.days_since_last_event < 0 and base.engagement_score > 1
    assert fx.customer_features(frame(spark, rows), as_of="2023-01-01", cap=True).head().engagement_score == 1.0


def test_recency_score_of_unknown_days_is_zero(spark):
    df = spark.createDataFrame([(None,), (0,), (90,), (500,)], "days_since_last_event int")
    assert [r.recency_score for r in fx.recency_score(df).collect()] == [0.0, 1.0, 0.5, 0.0]


def test_rolling_rows_and_calendar_differ_over_gaps(spark):
    rows = [event(str(d), ts=at(d), quantity=1, revenue=float(d + 1)) for d in (0, 1, 20, 21)]
    events = frame(spark, rows)
    by_rows = [r.units_rolling_7d for r in fx.demand_features(events).orderBy("date").collect()]
    by_calendar = [r.units_rolling_7d for r in fx.demand_features(events, "calendar").orderBy("date").collect()]
    assert by_rows == [None, 1, 2, 3]
    assert by_calendar == [None, 1, None, 1]
    with pytest.raises(ValueError):
        fx.rolling_demand(fx.daily_demand(events), frame="weeks")


def test_rolling_sums_share_one_window(spark):
    plan = fx.demand_features(frame(spark, [event()]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_lookback_counts_one_pass(spark):
    rows = [event(str(d), ts=at(-d), revenue=1.0) for d in (0, 6, 7, 8, 29, 31, 89, 91)] + [event("f", ts=at(1))]
    out = fx.lookback_aggregates(frame(spark, rows), as_of=DAY).head()
    assert (out.events_7d, out.events_14d, out.events_30d, out.events_90d) == (3, 4, 5, 7)
    assert out.revenue_90d == 7.0


def test_select_features_names_missing_columns(spark):
    with pytest.raises(ValueError, match="missing.*nope"):
        fx.select_features(spark.range(1), ["id", "nope"])


def test_empty_input(spark):
    empty = frame(spark, [])
    assert fx.customer_features(empty, DAY).count() == 0
    assert fx.demand_features(empty).count() == 0


PAYLOAD = dict(
    customer_id="C1",
    total_events=10,
    unique_products=2,
    total_revenue=100.0,
    avg_order_value=10.0,
    avg_session_sec=30.0,
    days_since_last_event=1,
    customer_tenure_days=100,
    active_days=5,
    engagement_score=0.5,
)


def violations(df):
    return df.head().violations


def test_churn_contract(spark):
    one = lambda **kw: spark.createDataFrame([{**PAYLOAD, **kw}])
    assert violations(contracts.validate_churn(one())) == []
    assert violations(contracts.validate_churn(one(total_revenue=-100.0))) == ["total_revenue_negative"]
    assert violations(contracts.validate_churn(one(engagement_score=1.5))) == ["engagement_score_above_one"]
    assert violations(contracts.validate_churn(one(total_revenue=float("nan")))) == ["total_revenue_missing"]
    assert violations(contracts.validate_churn(one().drop("total_events"))) == ["total_events_missing"]
    assert contracts.valid_rows(contracts.validate_churn(one())).count() == 1


def test_demand_contract(spark):
    df = spark.createDataFrame([("p", None, 1.0, 2.0, 3)], "product_id string, region string, daily_units double, daily_revenue double, daily_unique_buyers int")
    out = contracts.validate_demand(df)
    assert violations(out) == ["region_missing"]
    assert set(contracts.DEMAND_OPTIONAL) <= set(out.columns)


def test_document_contract(spark):
    df = spark.createDataFrame([(None, "long enough text"), ("d", "Hi"), ("e", None)], "doc_id string, text string")
    rows = {r.doc_id: r.violations for r in contracts.validate_document(df).collect()}
    assert rows == {"doc": [], "d": ["text_too_short"], "e": ["text_missing"]}
    assert contracts.validate_document(df.drop("doc_id").select(F.col("text"))).head().doc_id == "doc"
