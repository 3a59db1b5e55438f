"""Training, evaluation and batch scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.operators import evaluate, models, prep, scoring
from brightwater.operators.features import customer_features, demand_features
from brightwater.plans import sql
from brightwater.plans.prep import CHURN_KEYS, DEMAND_KEYS
from brightwater.plans.registry import query
from brightwater.schema import CHURN_FEATURES, DEMAND_FEATURES
from brightwater.session import scratch_path, written
from brightwater.sources.adapters import customer_events, table

CHURN_DAYS = 90
TRAINED_ON = 0.8


def cut_off(events: DataFrame) -> str:
    """The day four fifths into the events' span: features look before it, labels after it."""
    days = events.agg(F.min(F.to_date("timestamp")).alias("a"), F.max(F.to_date("timestamp")).alias("b"))
    return str(days.select(F.date_add("a", F.floor(TRAINED_ON * F.datediff("b", "a")).cast("int"))).first()[0])


def labelled_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the events before the cut-off; label 1 where no purchase follows within 90 days."""
    events = customer_events(spark, sf_dir)
    day = cut_off(events)
    frame = customer_features(events.where(F.col("timestamp") < F.lit(day).cast("timestamp")), day)
    after = F.lit(day).cast("timestamp")
    back = events.where((F.col("timestamp") >= after) & (F.col("timestamp") < after + F.expr(f"INTERVAL {CHURN_DAYS} DAYS")))
    back = back.select("customer_id").distinct().withColumn("back", F.lit(0.0))
    labelled = frame.join(back, "customer_id", "left").withColumn("label", F.coalesce("back", F.lit(1.0)))
    return written(labelled.select(*CHURN_KEYS, *CHURN_FEATURES, "label"), "labelled_churn")


def labelled_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's demand features; label: the units of the series' next active day."""
    series = Window.partitionBy("product_id", "region").orderBy("date")
    frame = demand_features(customer_events(spark, sf_dir)).withColumn("label", F.lead("daily_units").over(series).cast("double"))
    return written(frame.where("label IS NOT NULL").select(*DEMAND_KEYS, *DEMAND_FEATURES, "label"), "labelled_demand")


CUT_SQL = f"""{sql.CE}, cut AS (
  SELECT min(CAST(timestamp AS DATE)) + CAST(floor({TRAINED_ON} * date_diff('day', min(CAST(timestamp AS DATE)), max(CAST(timestamp AS DATE)))) AS INTEGER) AS d FROM ce)"""
LABELLED_CHURN = f"""{CUT_SQL},
  back AS (SELECT DISTINCT customer_id FROM ce, cut WHERE timestamp >= d AND timestamp < d + INTERVAL {CHURN_DAYS} DAYS),
  labelled AS (SELECT customer_id, region, CASE WHEN customer_id IN (SELECT customer_id FROM back) THEN 0 ELSE 1 END AS label
               FROM (SELECT DISTINCT customer_id, region FROM ce, cut WHERE timestamp < d))"""
LABELLED_DEMAND = f"""{sql.CE}, {sql.demand()}, labelled AS (
  SELECT * FROM (SELECT date, product_id, region, lead(daily_units) OVER (PARTITION BY product_id, region ORDER BY date) AS label FROM daily)
  WHERE label IS NOT NULL)"""


def held_sql(keys: list[str], seed: int = 42) -> str:
    """Whether a key is on the test side."""
    return f"CAST(concat('0x', substr(md5(concat_ws('|', '{seed}', {', '.join(keys)})), 1, 8)) AS BIGINT) % 10000 < 2000"


def _classes_sql(*checks: str) -> str:
    true = ", ".join(f"TRUE AS {c}" for c in checks)
    return f"WITH {LABELLED_CHURN} SELECT customer_id, region, label, {true} FROM labelled WHERE {held_sql(CHURN_KEYS)}"


def _units_sql() -> str:
    return f"WITH {LABELLED_DEMAND} SELECT date, product_id, region, label, TRUE AS finite, TRUE AS learned FROM labelled WHERE {held_sql(['product_id'])}"


CLASS_CHECKS = ["known_class", "in_unit", "consistent"]


def _class_checks() -> list:
    """What every score must satisfy: a class of the labels, a probability, and the class it speaks for."""
    chance = F.col("churn_probability")
    return [
        F.col("prediction").isin(0.0, 1.0).alias("known_class"),
        chance.between(0, 1).alias("in_unit"),
        ((F.col("prediction") == 1.0) == (chance > 0.5)).alias("consistent"),
    ]


def _fitted(train: DataFrame, keys: list[str], task: str, name: str):
    """A family with its defaults, fitted with its preparation; boosting ends by a part of the training rows."""
    churn = task == "classification"
    make = prep.churn_preparation if churn else prep.demand_preparation
    rows, valid = train, None
    if name != "random_forest":
        marked = models.holdout_split(train, keys, seed=7)
        rows, valid = marked.filter(~F.col("is_test")), marked.filter("is_test")
    columns = CHURN_FEATURES if churn else DEMAND_FEATURES
    return models.fit_with_preparation(rows, make(["label"]), columns, name, task, valid=valid)


def _classifier_scores(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    train, test = _split(labelled_churn(spark, sf_dir), CHURN_KEYS)
    scored = scoring.batch_predict(test, _fitted(train, CHURN_KEYS, "classification", name))
    return scored.select(*CHURN_KEYS, F.col("label").cast("int").alias("label"), *_class_checks())


def _regressor_scores(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    train, test = _split(labelled_demand(spark, sf_dir), ["product_id"])
    model = _fitted(train, ["product_id"], "regression", name)
    scored = scoring.batch_predict(test, model, task="regression")
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < 1e12)
    kept = [*DEMAND_KEYS, F.col("label").cast("long").alias("label"), finite.alias("finite")]
    return scored.select(*kept, F.lit(_learned(train, model)).alias("learned"))


def _learned(train: DataFrame, model) -> bool:
    """Whether the model's squared errors on what it learned from are below those of the labels' mean.

    No constant passes. Held-out rows cannot tell here: the generated units of a day say nothing of the next.
    """
    mean = train.agg(F.avg("label")).first()[0]
    of_mean, of_model = (F.avg(F.pow(F.col("label") - x, 2)) for x in (F.lit(mean), F.col("prediction")))
    fitted = scoring.batch_predict(train, model, task="regression")
    return bool(fitted.agg((of_model < of_mean).alias("lower")).first()[0])


@query("gbt_classifier", _classes_sql(*CLASS_CHECKS))
def gbt_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier_scores(spark, sf_dir, "xgboost")


@query("gbt_regressor", _units_sql())
def gbt_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressor_scores(spark, sf_dir, "xgboost")


@query("leafwise_classifier", _classes_sql(*CLASS_CHECKS))
def leafwise_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier_scores(spark, sf_dir, "lightgbm")


@query("leafwise_regressor", _units_sql())
def leafwise_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressor_scores(spark, sf_dir, "lightgbm")


@query("rf_classifier", _classes_sql(*CLASS_CHECKS))
def rf_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classifier_scores(spark, sf_dir, "random_forest")


@query("rf_regressor", _units_sql())
def rf_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressor_scores(spark, sf_dir, "random_forest")


def _split(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    marked = models.holdout_split(rows, keys)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def _prepared_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and validation customers, prepared as learned on the training side."""
    train, valid = _split(labelled_churn(spark, sf_dir), CHURN_KEYS)
    fitted = prep.churn_preparation([*CHURN_KEYS, "label"]).fit(train)
    return fitted.transform(train), fitted.transform(valid)


@query(
    "train_all",
    f"""WITH {LABELLED_CHURN} SELECT m.model, 'classification' AS task, count(*) AS train_size, TRUE AS imperfect, TRUE AS positive_f1
        FROM labelled, (VALUES ('xgboost'), ('lightgbm'), ('random_forest')) AS m(model)
        WHERE NOT ({held_sql(CHURN_KEYS)}) GROUP BY m.model""",
)
def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log; what the future brings is not known for certain from the past, so no metric is 1."""
    train, valid = _prepared_split(spark, sf_dir)
    _, log = models.train_all(train, valid, CHURN_FEATURES, early_stopping=True)
    metric = F.col("metrics")
    imperfect = (metric["accuracy"] < 1) & (metric["roc_auc"] < 1)
    return log.select("model", "task", "train_size", imperfect.alias("imperfect"), (metric["f1"] > 0).alias("positive_f1"))


@query(
    "early_stopping",
    """SELECT name AS model, 500 AS allowed, TRUE AS fewer, TRUE AS some
       FROM (VALUES ('xgboost'), ('lightgbm')) AS v(name)""",
)
def early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees kept by each boosted family, of 500 allowed, by 50 rounds of patience."""
    train, valid = _prepared_split(spark, sf_dir)
    names = ["xgboost", "lightgbm"]
    results, _ = models.train_all(train, valid, CHURN_FEATURES, names=names, early_stopping=True)
    kept = {name: r["model"].stages[-1].getNumTrees for name, r in results.items()}
    rows = [(name, models.FAMILIES[name].n_estimators, kept[name] < models.FAMILIES[name].n_estimators, kept[name] > 0) for name in names]
    return spark.createDataFrame(rows, "model string, allowed int, fewer boolean, some boolean")


@query(
    "holdout_split",
    """SELECT o_orderkey, o_custkey,
         CAST(concat('0x', substr(md5(concat('42|', CAST(o_custkey AS VARCHAR))), 1, 8)) AS BIGINT) % 10000 < 2000 AS is_test
       FROM orders""",
)
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return models.holdout_split(orders, ["o_custkey"])


@query("cross_validate", "SELECT 'random_forest' AS model, 5 AS folds, TRUE AS plausible, TRUE AS varies")
def cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default forest over five folds, its preparation fitted inside each."""
    fitted = models.cross_validate(
        labelled_churn(spark, sf_dir), CHURN_FEATURES, CHURN_KEYS, preparation=prep.churn_preparation([*CHURN_KEYS, "label"])
    )
    mean, spread = F.col("mean_metric"), F.col("std_metric")
    scores = models.fold_scores(spark, fitted)
    return scores.select(
        F.lit("random_forest").alias("model"), F.lit(fitted.getNumFolds()).alias("folds"), ((mean > 0) & (mean < 1)).alias("plausible"), (spread > 0).alias("varies")
    )


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, predictions and tied scores made from line items."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.when(F.col("l_quantity") > 33, 2).when(F.col("l_quantity") > 17, 1).otherwise(0).alias("class"),
        F.when(F.col("l_extendedprice") > 70000, 2).when(F.col("l_extendedprice") > 30000, 1).otherwise(0).alias("prediction"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("label"),
        F.round("l_discount", 2).alias("coarse"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("actual"),
        (F.col("l_extendedprice") / 2000).alias("estimate"),
    )


GUESSES = """guesses AS (
  SELECT CASE WHEN l_quantity > 33 THEN 2 WHEN l_quantity > 17 THEN 1 ELSE 0 END AS class,
         CASE WHEN l_extendedprice > 70000 THEN 2 WHEN l_extendedprice > 30000 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label, round(l_discount, 2) AS coarse,
         l_extendedprice AS score, l_quantity AS actual, l_extendedprice / 2000 AS estimate FROM lineitem)"""


@query(
    "eval_accuracy",
    f"WITH {GUESSES} SELECT round(avg(CASE WHEN class = prediction THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM guesses",
)
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.accuracy(guesses(spark, sf_dir), "class")


@query(
    "eval_f1_weighted",
    f"""WITH {GUESSES}, classes AS (
          SELECT c, count(*) FILTER (WHERE class = c) AS support, count(*) FILTER (WHERE prediction = c) AS predicted,
                 count(*) FILTER (WHERE class = c AND prediction = c) AS hit
          FROM guesses, (VALUES (0), (1), (2)) AS v(c) GROUP BY c)
        SELECT round(sum(support * coalesce(2.0 * hit / nullif(support + predicted, 0), 0)) / sum(support), 4) AS f1
        FROM classes""",
)
def eval_f1_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.f1_weighted(guesses(spark, sf_dir), "class")


def _auc_sql(score: str) -> str:
    return f"""SELECT '{score}' AS score, round((sum(CASE WHEN label = 1 THEN ar ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0)
        / (sum(label) * (count(*) - sum(label))), 4) AS roc_auc
      FROM (SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / CAST(2 AS DOUBLE) AS ar
            FROM guesses)"""


@query("eval_roc_auc", f"WITH {GUESSES} {_auc_sql('score')} UNION ALL {_auc_sql('coarse')}")
def eval_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = guesses(spark, sf_dir)
    values = [(c, evaluate.roc_auc(rows, c)) for c in ("score", "coarse")]
    return spark.createDataFrame(values, "score string, roc_auc double")


@query("eval_rmse", f"WITH {GUESSES} SELECT round(sqrt(avg((actual - estimate) * (actual - estimate))), 4) AS rmse FROM guesses")
def eval_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.rmse(guesses(spark, sf_dir), "actual", "estimate")


@query(
    "eval_mape",
    f"""WITH {GUESSES} SELECT round(avg(abs(actual - estimate) / greatest(abs(actual), 2.220446049250313e-16)), 4) AS mape
        FROM guesses""",
)
def eval_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.mape(guesses(spark, sf_dir), "actual", "estimate")


@query(
    "best_model",
    """WITH runs AS (SELECT l_returnflag AS model, round(avg(l_discount), 8) AS roc_auc, round(avg(l_tax), 8) AS rmse
                     FROM lineitem GROUP BY l_returnflag)
       SELECT model, concat(model, '_run') AS run, value, metric FROM (
         SELECT max_by(model, roc_auc) AS model, max(roc_auc) AS value, 'roc_auc' AS metric FROM runs
         UNION ALL SELECT min_by(model, rmse), min(rmse), 'rmse' FROM runs)""",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("model"))
        .agg(F.round(F.avg("l_discount"), 8).alias("a"), F.round(F.avg("l_tax"), 8).alias("r"))
        .select(
            "model",
            F.concat("model", F.lit("_run")).alias("run"),
            F.create_map(F.lit("roc_auc"), F.col("a"), F.lit("rmse"), F.col("r")).alias("metrics"),
        )
    )
    return evaluate.best_model(runs, "roc_auc").unionByName(evaluate.best_model(runs, "rmse"))


@query("model_save_load", _classes_sql("same"))
def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a saved and reloaded forest next to those of the fitted one."""
    train, valid = _prepared_split(spark, sf_dir)
    results, _ = models.train_all(train, valid, CHURN_FEATURES, names=["random_forest"], artifacts_dir=scratch_path(spark, "models"))
    run = results["random_forest"]
    first = scoring.batch_predict(valid, run["model"]).withColumnRenamed("churn_probability", "before")
    again = scoring.batch_predict(valid, models.load_model(run["artifact_path"])).select(*CHURN_KEYS, "churn_probability")
    same = (F.col("before") == F.col("churn_probability")).alias("same")
    return first.join(again, CHURN_KEYS).select(*CHURN_KEYS, F.col("label").cast("int").alias("label"), same)


@query("batch_predict", _classes_sql(*CLASS_CHECKS, "raw_kept"))
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted preparation and a separate model, applied to the raw rows of held-out customers."""
    train, test = _split(labelled_churn(spark, sf_dir), CHURN_KEYS)
    fitted = prep.churn_preparation([*CHURN_KEYS, "label"]).fit(train)
    results, _ = models.train_all(fitted.transform(train), fitted.transform(test), CHURN_FEATURES, names=["random_forest"])
    scored = scoring.batch_predict(test, results["random_forest"]["model"], preparation=fitted)
    raw = test.select(*CHURN_KEYS, F.col("total_events").alias("raw_events"))
    checked = scored.join(raw, CHURN_KEYS)
    kept = (F.col("total_events") == F.col("raw_events")).alias("raw_kept")
    return checked.select(*CHURN_KEYS, F.col("label").cast("int").alias("label"), *_class_checks(), kept)


@query("predict_proba", _classes_sql(*CLASS_CHECKS, "sums_to_one"))
def predict_proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _split(labelled_churn(spark, sf_dir), CHURN_KEYS)
    scored = scoring.predict_proba(test, _fitted(train, CHURN_KEYS, "classification", "random_forest"))
    both = F.col("probabilities")
    whole = F.abs(both[0] + both[1] - 1) < 1e-9
    return scored.select(*CHURN_KEYS, F.col("label").cast("int").alias("label"), *_class_checks(), (whole & (both[1] == F.col("churn_probability"))).alias("sums_to_one"))


@query(
    "predict_with_function",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
          {sql.r('0.5 * l_quantity - 1.0 * l_discount + 0.25 * l_tax', 'prediction', 6)} FROM lineitem""",
)
def predict_with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model from outside MLlib, scored in Arrow batches."""

    def linear():
        weights = np.array([0.5, -1.0, 0.25])
        return lambda matrix: np.asarray(matrix, dtype=float) @ weights

    line = table(spark, sf_dir, "lineitem")
    scored = scoring.predict_with_function(line, ["l_quantity", "l_discount", "l_tax"], linear)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("prediction") + 1e-7, 6).alias("prediction"))
