"""Event schema, feature lists and row contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# The event schema of the ingestion contract.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("revenue", T.DoubleType(), True),
        T.StructField("session_duration_sec", T.IntegerType(), True),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("date", T.StringType(), True),
    ]
)

MANDATORY = ["event_id", "customer_id", "timestamp"]
NON_NEGATIVE = ["revenue", "quantity"]
PARTITION_COLUMNS = ["date", "region"]
RELIABILITY_TARGET = 0.998

# Model input columns, in order.
CHURN_FEATURES = [
    "total_events",
    "unique_products",
    "total_revenue",
    "avg_order_value",
    "avg_session_sec",
    "days_since_last_event",
    "customer_tenure_days",
    "active_days",
    "engagement_score",
]
DEMAND_FEATURES = [
    "daily_units",
    "daily_revenue",
    "daily_unique_buyers",
    "revenue_rolling_7d",
    "units_rolling_7d",
    "revenue_rolling_14d",
    "units_rolling_14d",
    "revenue_rolling_30d",
    "units_rolling_30d",
]

ROLLING_DAYS = [7, 14, 30]
LOOKBACK_DAYS = [7, 14, 30, 90]


def feature_columns(task: str) -> list[str]:
    """Model inputs for a task; anything but churn/classification means demand."""
    return CHURN_FEATURES if task in ("churn", "classification") else DEMAND_FEATURES


def require_columns(present: list[str], wanted: list[str]) -> None:
    absent = sorted(set(wanted) - set(present))
    if absent:
        raise ValueError(f"the frame is missing {', '.join(absent)}")
