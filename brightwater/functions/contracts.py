"""Row contracts: per row the list of violated rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.schema import CHURN_FEATURES

# Required and optional fields of the demand contract.
DEMAND_REQUIRED = ["product_id", "region", "daily_units", "daily_revenue", "daily_unique_buyers"]
DEMAND_OPTIONAL = [
    "revenue_rolling_7d",
    "units_rolling_7d",
    "revenue_rolling_14d",
    "units_rolling_14d",
    "revenue_rolling_30d",
    "units_rolling_30d",
]
MIN_TEXT_CHARS = 10
DEFAULT_DOC_ID = "doc"


def _violations(tests: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(rule)) for test, rule in tests]))


def _missing(df: DataFrame, column: str) -> Column:
    """Null, NaN, or no such column at all."""
    if column not in df.columns:
        return F.lit(True)
    empty = F.col(column).isNull()
    return empty | F.isnan(column) if dict(df.dtypes)[column] in ("double", "float") else empty


def validate_churn(df: DataFrame) -> DataFrame:
    """``violations`` of the scoring contract: all fields, amounts >= 0, engagement <= 1."""
    tests = [(_missing(df, c), f"{c}_missing") for c in ["customer_id", *CHURN_FEATURES]]
    tests += [(F.col(c) < 0, f"{c}_negative") for c in CHURN_FEATURES if c in df.columns]
    if "engagement_score" in df.columns:
        above = (F.col("engagement_score") > 1) & ~F.isnan(F.col("engagement_score").cast("double"))
        tests.append((above, "engagement_score_above_one"))
    return df.withColumn("violations", _violations(tests))


def validate_demand(df: DataFrame) -> DataFrame:
    """``violations`` of the demand contract; absent rolling fields become null columns."""
    out = df.withColumns({c: F.lit(None).cast("double") for c in DEMAND_OPTIONAL if c not in df.columns})
    return out.withColumn("violations", _violations([(_missing(df, c), f"{c}_missing") for c in DEMAND_REQUIRED]))


def validate_document(df: DataFrame) -> DataFrame:
    """``violations`` of the document contract; a missing id becomes ``doc``."""
    given = F.col("doc_id").cast("string") if "doc_id" in df.columns else F.lit(None).cast("string")
    out = df.withColumn("doc_id", F.coalesce(given, F.lit(DEFAULT_DOC_ID)))
    tests = [(F.col("text").isNull(), "text_missing"), (F.length("text") < MIN_TEXT_CHARS, "text_too_short")]
    return out.withColumn("violations", _violations(tests))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") == 0).drop("violations")
