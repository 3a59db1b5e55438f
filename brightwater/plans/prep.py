"""Feature preparation."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.operators import prep
from brightwater.operators.features import customer_features, demand_features
from brightwater.operators.quantiles import exact_quantiles
from brightwater.plans import sql
from brightwater.plans.registry import query, rounded
from brightwater.schema import CHURN_FEATURES, DEMAND_FEATURES
from brightwater.session import scratch_path, written
from brightwater.sources.adapters import customer_events

CHURN_KEYS = ["customer_id", "region"]
DEMAND_KEYS = ["date", "product_id", "region"]


def churn_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features with some session lengths missing, as a table."""
    features = customer_features(customer_events(spark, sf_dir), sql.AS_OF)
    gap = F.when(F.col("active_days") % 7 != 0, F.col("avg_session_sec"))
    return written(features.withColumn("avg_session_sec", gap).select(*CHURN_KEYS, *CHURN_FEATURES), "customer_features")


def demand_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand features as a table; the first day of a series has no rolling sums."""
    return written(demand_features(customer_events(spark, sf_dir)).select(*DEMAND_KEYS, *DEMAND_FEATURES), "demand_features")


CHURN_SQL = f"""{sql.CE}, {sql.customer_features()},
frame AS (SELECT * REPLACE (CASE WHEN active_days % 7 <> 0 THEN avg_session_sec END AS avg_session_sec) FROM features)"""
DEMAND_SQL = f"{sql.CE}, {sql.demand()}, {sql.rolling()}, frame AS (SELECT * FROM demand)"


def _select(source: str, keys: list[str], columns: list[str], stats: str, each: str, one_row: str, name: str) -> str:
    """CTEs: one row of statistics, then every column computed from it."""
    numbers = ", ".join(stats.format(c=c) for c in columns)
    values = ", ".join(f"{each.format(c=c)} AS {c}" for c in columns)
    keyed = ", ".join(f"{source}.{k}" for k in keys)
    return f"{one_row} AS (SELECT {numbers} FROM {source}), {name} AS (SELECT {keyed}, {values} FROM {source}, {one_row})"


BOUNDS = "quantile_cont(CAST({c} AS DOUBLE), 0.01) AS {c}_lo, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS {c}_hi"
CLIP = "CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE CAST({c} AS DOUBLE) END"
MEDIAN, MEAN = "quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_fill", "avg({c}) AS {c}_fill"
FILL = "coalesce(CAST({c} AS DOUBLE), {c}_fill)"
ROBUST = """quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_mid,
  quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_span"""
STANDARD = "avg({c}) AS {c}_mid, stddev_pop({c}) AS {c}_span"
SCALE = "({c} - {c}_mid) / CASE WHEN {c}_span = 0 THEN 1 ELSE {c}_span END"


def clip_sql(keys, columns, source="frame"):
    return _select(source, keys, columns, BOUNDS, CLIP, "bounds", "clipped")


def fill_sql(keys, columns, kind, source="clipped"):
    return _select(source, keys, columns, kind, FILL, "fills", "filled")


def scale_sql(keys, columns, kind, source="filled"):
    return _select(source, keys, columns, kind, SCALE, "scales", "scaled")


def out_sql(keys: list[str], columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(keys)}, {', '.join(sql.r(c) for c in columns)} FROM {source}"


def out(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.select(*keys, *[rounded(c).alias(c) for c in columns])


def fit_apply(df: DataFrame, stage: Estimator, keys: list[str], columns: list[str]) -> DataFrame:
    return out(stage.fit(df).transform(df), keys, columns)


@query(
    "quantile_bounds",
    f"WITH {CHURN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql.r(f'quantile_cont(CAST({c} AS DOUBLE), 0.01)', 'q_low')}, "
        f"{sql.r(f'quantile_cont(CAST({c} AS DOUBLE), 0.99)', 'q_high')} FROM frame"
        for c in CHURN_FEATURES
    ),
)
def quantile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = exact_quantiles(churn_frame(spark, sf_dir), CHURN_FEATURES, [0.01, 0.99])
    rows = [(c, low, high) for c, (low, high) in bounds.items()]
    return spark.createDataFrame(rows, "feature string, q_low double, q_high double").select(
        "feature", rounded("q_low").alias("q_low"), rounded("q_high").alias("q_high")
    )


@query(
    "clip_outliers",
    f"WITH {CHURN_SQL}, {clip_sql(CHURN_KEYS, CHURN_FEATURES)} {out_sql(CHURN_KEYS, CHURN_FEATURES, 'clipped')}",
)
def clip_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_apply(churn_frame(spark, sf_dir), prep.Clipper(CHURN_FEATURES), CHURN_KEYS, CHURN_FEATURES)


@query(
    "impute_median",
    f"""WITH {CHURN_SQL}, {clip_sql(CHURN_KEYS, CHURN_FEATURES)}, {fill_sql(CHURN_KEYS, CHURN_FEATURES, MEDIAN)}
        {out_sql(CHURN_KEYS, CHURN_FEATURES, 'filled')}""",
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Pipeline(stages=[prep.Clipper(CHURN_FEATURES), prep.Filler(CHURN_FEATURES, "median")])
    return fit_apply(churn_frame(spark, sf_dir), stage, CHURN_KEYS, CHURN_FEATURES)


@query(
    "impute_mean",
    f"""WITH {DEMAND_SQL}, {clip_sql(DEMAND_KEYS, DEMAND_FEATURES)}, {fill_sql(DEMAND_KEYS, DEMAND_FEATURES, MEAN)}
        {out_sql(DEMAND_KEYS, DEMAND_FEATURES, 'filled')}""",
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Pipeline(stages=[prep.Clipper(DEMAND_FEATURES), prep.Filler(DEMAND_FEATURES, "mean")])
    return fit_apply(demand_frame(spark, sf_dir), stage, DEMAND_KEYS, DEMAND_FEATURES)


@query(
    "robust_scale",
    f"WITH {CHURN_SQL}, {scale_sql(CHURN_KEYS, CHURN_FEATURES, ROBUST, 'frame')} {out_sql(CHURN_KEYS, CHURN_FEATURES, 'scaled')}",
)
def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_apply(churn_frame(spark, sf_dir), prep.Scaler(CHURN_FEATURES, "robust"), CHURN_KEYS, CHURN_FEATURES)


@query(
    "standard_scale",
    f"WITH {DEMAND_SQL}, {scale_sql(DEMAND_KEYS, DEMAND_FEATURES, STANDARD, 'frame')} {out_sql(DEMAND_KEYS, DEMAND_FEATURES, 'scaled')}",
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_apply(demand_frame(spark, sf_dir), prep.Scaler(DEMAND_FEATURES, "standard"), DEMAND_KEYS, DEMAND_FEATURES)


CHURN_PREPARED = f"""WITH {CHURN_SQL}, {clip_sql(CHURN_KEYS, CHURN_FEATURES)},
  {fill_sql(CHURN_KEYS, CHURN_FEATURES, MEDIAN)}, {scale_sql(CHURN_KEYS, CHURN_FEATURES, ROBUST)}
  {out_sql(CHURN_KEYS, CHURN_FEATURES, 'scaled')}"""


@query("churn_preparation", CHURN_PREPARED)
def churn_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = churn_frame(spark, sf_dir)
    return out(prep.churn_preparation(CHURN_KEYS).fit(frame).transform(frame), CHURN_KEYS, CHURN_FEATURES)


@query(
    "demand_preparation",
    f"""WITH {DEMAND_SQL}, {clip_sql(DEMAND_KEYS, DEMAND_FEATURES)},
        {fill_sql(DEMAND_KEYS, DEMAND_FEATURES, MEAN)}, {scale_sql(DEMAND_KEYS, DEMAND_FEATURES, STANDARD)}
        {out_sql(DEMAND_KEYS, DEMAND_FEATURES, 'scaled')}""",
)
def demand_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = demand_frame(spark, sf_dir)
    return out(prep.demand_preparation(DEMAND_KEYS).fit(frame).transform(frame), DEMAND_KEYS, DEMAND_FEATURES)


@query("preparation_save_load", CHURN_PREPARED)
def preparation_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = churn_frame(spark, sf_dir)
    path = scratch_path(spark, "preparations")
    prep.save_fitted({"churn": prep.churn_preparation(CHURN_KEYS).fit(frame)}, path)
    return out(prep.load_fitted(spark, path)["churn"].transform(frame), CHURN_KEYS, CHURN_FEATURES)
