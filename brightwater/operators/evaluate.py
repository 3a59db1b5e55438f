"""Metrics over a table of labels and predictions."""

from __future__ import annotations

import sys
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON = sys.float_info.epsilon

# Which way each metric is better.
LOWER_IS_BETTER = {"rmse", "mape", "train_duration_sec"}


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label).cast("double") == F.col(prediction).cast("double"), 1.0).otherwise(0.0)
    return df.agg(F.round(F.avg(hit), 4).alias("accuracy"))


def f1_weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per class weighted by its share of the labels; undefined counts as 0.

    Rows collapse to the confusion counts first; the rest works on a few rows.
    """
    confusion = df.groupBy(
        F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("guess").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("support") + F.col("predicted")), F.lit(0.0))
    weighted = F.try_divide(F.sum(f1 * F.col("support")), F.sum("support"))
    return classes.agg(F.round(weighted, 4).alias("f1"))


def roc_auc(df: DataFrame, score: str = "churn_probability", label: str = "label") -> float | None:
    """Exact, tie-aware area under the ROC curve, to 4 places; None with one class only.

    Equal scores collapse to weighted rows first. MLlib then sorts by range and
    accumulates per partition, so no window over the whole table is needed.
    Runs jobs.
    """
    rows = df.groupBy(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sides = kept.agg(F.max("label").alias("high"), F.min("label").alias("low")).head()
        if sides["high"] is None or sides["high"] == sides["low"]:
            return None
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", weightCol="weight", numBins=0
        )
        return round(evaluator.evaluate(kept), 4)
    finally:
        kept.unpersist()


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    error = F.col(label).cast("double") - F.col(prediction)
    return df.agg(F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"))


def mape(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    actual = F.col(label).cast("double")
    share = F.abs(actual - F.col(prediction)) / F.greatest(F.abs(actual), F.lit(EPSILON))
    return df.agg(F.round(F.avg(share), 4).alias("mape"))


def evaluate_model(scored: DataFrame, label: str = "label", task: str = "classification") -> dict[str, Any]:
    """All metrics of a task for a scored table. Runs jobs; rows are scored once for all of them."""
    from pyspark.ml.functions import vector_to_array

    columns = [F.col(label), F.col("prediction")]
    by_chance = task == "classification" and "probability" in scored.columns
    if by_chance:
        columns.append(vector_to_array("probability")[1].alias("_score"))
    kept = scored.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if task != "classification":
            return {"rmse": rmse(kept, label).head()[0], "mape": mape(kept, label).head()[0]}
        metrics = {"accuracy": accuracy(kept, label).head()[0], "f1": f1_weighted(kept, label).head()[0]}
        if by_chance:
            metrics["roc_auc"] = roc_auc(kept, "_score", label)
        return metrics
    finally:
        kept.unpersist()


def best_model(runs: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The run with the best metric: lowest for errors, highest otherwise.

    Runs without the metric rank last; equal runs are decided by name.
    """
    value = F.col("metrics")[metric]
    better = -value if metric in LOWER_IS_BETTER else value
    rank = F.struct(better.isNotNull(), F.coalesce(better, F.lit(0.0)))
    best = F.min_by(
        F.struct("model", "run", value.alias("value")),
        F.struct(~rank["col1"], -rank["col2"], F.col("model")),
    )
    return runs.agg(best.alias("b")).select("b.*").withColumn("metric", F.lit(metric))
