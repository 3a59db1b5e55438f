"""Aggregations and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.operators import features as fx
from brightwater.operators.quality import clean_events
from brightwater.plans import sql
from brightwater.plans.registry import query, rounded, stamp
from brightwater.schema import LOOKBACK_DAYS
from brightwater.session import written
from brightwater.sources.adapters import customer_events

FEATURES = f"WITH {sql.CE}, {sql.customer_features()}"
KEYS = ["customer_id", "region"]
AGGREGATES_SQL = f"""customer_id, region, total_events, unique_products, round(total_revenue, 4) AS total_revenue,
  {sql.r("avg_order_value")}, {sql.r("avg_session_sec")},
  strftime(last_event_ts, '%Y-%m-%d %H:%M:%S') AS last_event, strftime(first_event_ts, '%Y-%m-%d %H:%M:%S') AS first_event,
  active_days"""
RECENCY_SQL = "days_since_last_event, customer_tenure_days"


def aggregate_columns() -> list:
    return [
        *KEYS,
        "total_events",
        "unique_products",
        F.round("total_revenue", 4).alias("total_revenue"),
        rounded("avg_order_value").alias("avg_order_value"),
        rounded("avg_session_sec").alias("avg_session_sec"),
        stamp("last_event_ts").alias("last_event"),
        stamp("first_event_ts").alias("first_event"),
        "active_days",
    ]


RECENCY = ["days_since_last_event", "customer_tenure_days"]


@query("customer_aggregates", f"{FEATURES} SELECT {AGGREGATES_SQL} FROM agg")
def customer_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.customer_aggregates(customer_events(spark, sf_dir)).select(*aggregate_columns())


@query("recency_features", f"{FEATURES} SELECT customer_id, region, {RECENCY_SQL} FROM recency")
def recency_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx.customer_aggregates(customer_events(spark, sf_dir))
    return fx.recency_features(base, sql.AS_OF).select(*KEYS, *RECENCY)


@query("recency_score", f"{FEATURES} SELECT customer_id, region, {sql.r('recency_score')} FROM scored")
def recency_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx.recency_features(fx.customer_aggregates(customer_events(spark, sf_dir)), sql.AS_OF)
    return fx.recency_score(base).select(*KEYS, rounded("recency_score").alias("recency_score"))


@query("engagement_score", f"{FEATURES} SELECT customer_id, region, {sql.r('engagement_score')} FROM features")
def engagement_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx.recency_features(fx.customer_aggregates(customer_events(spark, sf_dir)), sql.AS_OF)
    scored = fx.engagement_score(fx.recency_score(base))
    return scored.select(*KEYS, rounded("engagement_score").alias("engagement_score"))


@query(
    "customer_features",
    f"""{FEATURES} SELECT {AGGREGATES_SQL}, {RECENCY_SQL}, {sql.r("recency_score")}, {sql.r("engagement_score")}
        FROM features""",
)
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.customer_features(customer_events(spark, sf_dir), sql.AS_OF).select(
        *aggregate_columns(),
        *RECENCY,
        rounded("recency_score").alias("recency_score"),
        rounded("engagement_score").alias("engagement_score"),
    )


@query(
    "daily_demand",
    f"""WITH {sql.CE}, {sql.demand()} SELECT date, product_id, region, daily_units,
        round(daily_revenue, 4) AS daily_revenue, daily_unique_buyers FROM daily""",
)
def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fx.daily_demand(customer_events(spark, sf_dir))
    return daily.withColumn("daily_revenue", F.round("daily_revenue", 4))


def demand_output(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in df.columns if "revenue" in c})


@query(
    "rolling_demand",
    f"WITH {sql.CE}, {sql.demand()}, {sql.rolling('calendar')} SELECT {sql.DEMAND_OUT} FROM demand",
)
def rolling_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar-day frame; ``demand_features`` shows the row frame."""
    return demand_output(fx.rolling_demand(fx.daily_demand(customer_events(spark, sf_dir)), frame="calendar"))


@query(
    "demand_features",
    f"""WITH {sql.CE}, {sql.latest("ce", "clean", f"{sql.MANDATORY} AND {sql.PLAUSIBLE}")},
        {sql.demand("clean")}, {sql.rolling()} SELECT {sql.DEMAND_OUT} FROM demand""",
)
def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning reads the events twice, so they are joined once and written."""
    events = written(customer_events(spark, sf_dir), "events")
    return demand_output(fx.demand_features(clean_events(events)))


_LOOKBACK = ", ".join(
    f"""count(*) FILTER (WHERE timestamp >= TIMESTAMP '{sql.AS_OF}' - INTERVAL {n} DAYS AND timestamp <= TIMESTAMP '{sql.AS_OF}')
          AS events_{n}d,
        round(coalesce(sum(revenue) FILTER (WHERE timestamp >= TIMESTAMP '{sql.AS_OF}' - INTERVAL {n} DAYS
          AND timestamp <= TIMESTAMP '{sql.AS_OF}'), 0), 4) AS revenue_{n}d"""
    for n in LOOKBACK_DAYS
)


@query("lookback_aggregates", f"WITH {sql.CE} SELECT customer_id, {_LOOKBACK} FROM ce GROUP BY customer_id")
def lookback_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fx.lookback_aggregates(customer_events(spark, sf_dir), sql.AS_OF)
    return out.withColumns({f"revenue_{n}d": F.round(f"revenue_{n}d", 4) for n in LOOKBACK_DAYS})
