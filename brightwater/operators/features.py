"""Customer and demand features."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwater.schema import LOOKBACK_DAYS, ROLLING_DAYS, require_columns

AsOf = str | date | datetime | None


def as_of_column(as_of: AsOf) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def select_features(df: DataFrame, columns: list[str]) -> DataFrame:
    require_columns(df.columns, columns)
    return df.select(*columns)


def customer_aggregates(events: DataFrame) -> DataFrame:
    """Totals per customer and region; a null region is a group of its own.

    Both distinct counts are rewritten by Catalyst into one expanded, map-side
    combined aggregate keyed by the distinct values as well, so a hot customer
    is spread over tasks before the final counts meet.
    """
    return events.groupBy("customer_id", "region").agg(
        F.count("event_id").alias("total_events"),
        F.countDistinct("product_id").alias("unique_products"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("revenue").alias("avg_order_value"),
        F.avg("session_duration_sec").alias("avg_session_sec"),
        F.max("timestamp").alias("last_event_ts"),
        F.min("timestamp").alias("first_event_ts"),
        F.countDistinct(F.to_date("timestamp")).alias("active_days"),
    )


def recency_features(aggregates: DataFrame, as_of: AsOf = None) -> DataFrame:
    now = as_of_column(as_of)
    return aggregates.withColumns(
        {
            "days_since_last_event": F.datediff(now, F.col("last_event_ts")),
            "customer_tenure_days": F.datediff(now, F.col("first_event_ts")),
        }
    )


def recency_score(df: DataFrame, horizon_days: int = 180) -> DataFrame:
    """1 today, 0 from ``horizon_days`` on (and for unknown recency)."""
    left = F.lit(1.0) - F.col("days_since_last_event") / F.lit(horizon_days)
    return df.withColumn("recency_score", F.greatest(F.lit(0.0), left))


def engagement_score(df: DataFrame, cap: bool = False) -> DataFrame:
    """Weighted recency, activity and volume. ``cap`` forces it into [0, 1]."""
    activity = F.col("active_days") / F.lit(90)
    volume = F.least(F.col("total_events") / F.lit(100), F.lit(1.0))
    score = F.col("recency_score") * 0.4 + activity * 0.3 + volume * 0.3
    if cap:
        score = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    return df.withColumn("engagement_score", score)


def customer_features(events: DataFrame, as_of: AsOf = None, cap: bool = False) -> DataFrame:
    return (
        events.transform(customer_aggregates)
        .transform(recency_features, as_of)
        .transform(recency_score)
        .transform(engagement_score, cap)
    )


def daily_demand(events: DataFrame) -> DataFrame:
    """Units, revenue and buyers per day, product and region (unsorted)."""
    return events.groupBy(
        F.date_format("timestamp", "yyyy-MM-dd").alias("date"), "product_id", "region"
    ).agg(
        F.sum("quantity").alias("daily_units"),
        F.sum("revenue").alias("daily_revenue"),
        F.countDistinct("customer_id").alias("daily_unique_buyers"),
    )


def rolling_demand(daily: DataFrame, days: list[int] = ROLLING_DAYS, frame: str = "rows") -> DataFrame:
    """Sums over the preceding entries of each product and region.

    ``rows``: the previous n active days. ``calendar``: the previous n calendar
    days. The current day is excluded either way. A series holds one row per
    day, so no window group outgrows the length of the calendar.
    """
    series = Window.partitionBy("product_id", "region")
    if frame == "rows":
        ordered = series.orderBy("date")
        spans = {n: ordered.rowsBetween(-n, -1) for n in days}
    elif frame == "calendar":
        ordered = series.orderBy(F.unix_date(F.to_date("date")))
        spans = {n: ordered.rangeBetween(-n, -1) for n in days}
    else:
        raise ValueError(f"frame must be 'rows' or 'calendar', not {frame!r}")
    sums: dict[str, Column] = {}
    for n in days:
        sums[f"revenue_rolling_{n}d"] = F.sum("daily_revenue").over(spans[n])
        sums[f"units_rolling_{n}d"] = F.sum("daily_units").over(spans[n])
    return daily.withColumns(sums)


def demand_features(events: DataFrame, frame: str = "rows") -> DataFrame:
    return events.transform(daily_demand).transform(rolling_demand, ROLLING_DAYS, frame)


def lookback_aggregates(events: DataFrame, as_of: AsOf = None, days: list[int] = LOOKBACK_DAYS) -> DataFrame:
    """Events and revenue per customer in the last n days before ``as_of``, one pass."""
    now = as_of_column(as_of)
    columns = []
    for n in days:
        inside = (F.col("timestamp") >= now - F.expr(f"INTERVAL {n} DAYS")) & (F.col("timestamp") <= now)
        columns.append(F.count_if(inside).alias(f"events_{n}d"))
        columns.append(F.coalesce(F.sum(F.when(inside, F.col("revenue"))), F.lit(0.0)).alias(f"revenue_{n}d"))
    return events.groupBy("customer_id").agg(*columns)
