"""Monitoring tables over a prediction log and over feature samples.

Log columns, each used where it applies: ``model_name``, ``label``,
``error_type``, ``latency_seconds``, ``cached``, ``accuracy``, ``roc_auc``,
``ts``. The groups are few; partial aggregation keeps a dominant model cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.operators.quantiles import double_literal, exact_quantiles, numeric_value

# Latency bucket bounds (seconds) and alert levels.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
ACCURACY_ALERT = 0.85
DRIFT_ALERT = 0.2
SHARE_FLOOR = 1e-4


def _or_unknown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias(column)


def predictions_total(log: DataFrame) -> DataFrame:
    return log.groupBy("model_name", _or_unknown("label")).agg(F.count(F.lit(1)).alias("predictions"))


def errors_total(errors: DataFrame) -> DataFrame:
    return errors.groupBy("model_name", _or_unknown("error_type")).agg(F.count(F.lit(1)).alias("errors"))


def latency_histogram(log: DataFrame, buckets: list[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative count per bound (``le``), with the sum and count of each model."""
    value = F.col("latency_seconds")
    counts = [F.count_if(value <= bound).alias(f"b{i}") for i, bound in enumerate(buckets)]
    per_model = log.filter(value.isNotNull()).groupBy("model_name").agg(
        *counts, F.count(F.lit(1)).alias("latency_count"), F.sum(value).alias("latency_sum")
    )
    bounds = [(str(bound), F.col(f"b{i}")) for i, bound in enumerate(buckets)] + [("+Inf", F.col("latency_count"))]
    rows = F.array(*[F.struct(F.lit(le).alias("le"), n.alias("cumulative")) for le, n in bounds])
    return per_model.select("model_name", F.explode(rows).alias("r"), "latency_count", "latency_sum").select(
        "model_name", "r.le", "r.cumulative", "latency_count", "latency_sum"
    )


def _latest(log: DataFrame, by: str, value: str) -> DataFrame:
    """The newest non-null value per group; the larger one if two share the instant."""
    known = log.filter(F.col(value).isNotNull())
    return known.groupBy(by).agg(F.max_by(value, F.struct("ts", value)).alias(value))


def accuracy_gauge(log: DataFrame, alert_below: float = ACCURACY_ALERT) -> DataFrame:
    return _latest(log, "model_name", "accuracy").withColumn("alert", F.col("accuracy") < alert_below)


def roc_auc_gauge(log: DataFrame) -> DataFrame:
    return _latest(log, "model_name", "roc_auc")


def ingest_run_stats(runs: DataFrame) -> DataFrame:
    """Records processed (sum) and reliability (latest) per ``pipeline_name``."""
    return runs.groupBy("pipeline_name").agg(
        F.sum("records").alias("records_processed"),
        F.max_by("reliability", F.struct("ts", "reliability")).alias("reliability"),
    )


def store_hits_misses(log: DataFrame) -> DataFrame:
    return log.groupBy("model_name").agg(
        F.count_if("cached").alias("hits"), F.count_if(~F.col("cached")).alias("misses")
    )


def _bin_shares(df: DataFrame, edges: dict[str, list[float]], name: str) -> DataFrame:
    """(feature, bin, share) from one aggregate over the whole sample, no shuffle of rows."""
    positions, counts, cells = [], [], []
    for i, (feature, cuts) in enumerate(edges.items()):
        value = numeric_value(feature)
        above = " + ".join(f"CAST({value} > {double_literal(c)} AS INT)" for c in cuts) or f"CAST({value} > 0 AS INT) * 0"
        positions.append(F.expr(above).alias(f"p{i}"))
        counts.append(F.expr(f"count(p{i})").alias(f"t{i}"))
        for b in range(len(cuts) + 1):
            counts.append(F.expr(f"count_if(p{i} = {b})").alias(f"c{i}_{b}"))
            cells.append(f"struct('{feature}' AS feature_name, {b} AS bin, c{i}_{b} AS n, t{i} AS total)")
    rows = df.select(*positions).agg(*counts).select(F.explode(F.expr(f"array({', '.join(cells)})")).alias("c")).select("c.*")
    share = F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))
    return rows.select("feature_name", "bin", F.greatest(share, F.lit(SHARE_FLOOR)).alias(name))


def psi_drift(
    baseline: DataFrame, current: DataFrame, features: list[str], model_name: str = "model", bins: int = 10
) -> DataFrame:
    """Population stability index per feature: sum of (a - e) * ln(a / e) over bins.

    Bins are cut at the baseline's exact quantiles (equal cuts merge, a value on
    a cut belongs to the lower bin) and empty bins count as a share of 1e-4.
    Learning the cuts runs jobs on the baseline; nulls and NaN are left out.
    """
    probabilities = [i / bins for i in range(1, bins)]
    learned = exact_quantiles(baseline, features, probabilities)
    edges = {f: sorted({c for c in cuts if c is not None}) for f, cuts in learned.items()}
    expected = _bin_shares(baseline, edges, "expected")
    actual = _bin_shares(current, edges, "actual")
    floor = F.lit(SHARE_FLOOR)
    e, a = F.coalesce("expected", floor), F.coalesce("actual", floor)
    return (
        expected.join(actual, ["feature_name", "bin"], "full")
        .groupBy("feature_name")
        .agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
        .select(F.lit(model_name).alias("model_name"), "feature_name", "psi")
    )


def drift_alert(psi: DataFrame, threshold: float = DRIFT_ALERT) -> DataFrame:
    return psi.filter(F.col("psi") > threshold)
