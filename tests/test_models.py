from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightwater.operators import evaluate, models, scoring


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 2))
    rows = [(f"k{i}", float(a), float(b), float(a + b > 0)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "key string, a double, b double, label double").cache()


FEW = {name: {"n_estimators": 4, "max_depth": 3} for name in models.MODEL_NAMES}


def test_unknown_model():
    with pytest.raises(ValueError, match="Unknown model"):
        models.model_for("unsupported_model")


def test_names_ignore_case_and_unknown_overrides_are_ignored(spark):
    model, config = models.model_for("XGBoost", "classification", n_estimators=3, colour="red")
    assert (type(model).__name__, config.n_estimators, config.learning_rate) == ("GBTClassifier", 3, 0.05)
    forest, config = models.model_for("random_forest", "anything else is regression")
    assert (type(forest).__name__, config.n_estimators) == ("RandomForestRegressor", 300)
    assert models.run_params("lightgbm", models.FAMILIES["lightgbm"])["lgbm_min_child_samples"] == "20"


def test_train_all_logs_runs_and_saves_models(spark, separable, tmp_path):
    marked = models.holdout_split(separable, ["key"])
    train, valid = marked.filter("NOT is_test"), marked.filter("is_test")
    results, log = models.train_all(train, valid, ["a", "b"], overrides=FEW, artifacts_dir=str(tmp_path))
    assert sorted(results) == ["lightgbm", "random_forest", "xgboost"]
    runs = {r.model: r for r in log.collect()}
    assert all(r.train_size == train.count() for r in runs.values())
    assert runs["xgboost"].params["xgb_n_estimators"] == "4"
    assert all(r.metrics["accuracy"] > 0.75 and 0.75 < r.metrics["roc_auc"] <= 1 for r in runs.values())
    best = evaluate.best_model(log, "roc_auc").head()
    assert best.value == max(r.metrics["roc_auc"] for r in runs.values())
    loaded = models.load_model(results["random_forest"]["artifact_path"])
    again = scoring.batch_predict(valid, loaded).select("key", "churn_probability")
    first = scoring.batch_predict(valid, results["random_forest"]["model"]).select("key", "churn_probability")
    assert sorted(again.collect()) == sorted(first.collect())


def test_a_model_with_its_preparation_survives_saving(spark, tmp_path):
    from pyspark.ml import Pipeline

    from brightwater.operators import prep

    rows = spark.createDataFrame([(f"k{i}", float(i % 9), None if i % 5 == 0 else float(i), float(i % 2)) for i in range(60)], "key string, a double, b double, label double")
    stages = [prep.FeatureSelector(["a", "b"], ["key", "label"]), prep.Clipper(["a", "b"]), prep.Filler(["a", "b"]), prep.Scaler(["a", "b"])]
    model = models.fit_with_preparation(rows, Pipeline(stages=stages), ["a", "b"], "random_forest", "classification", **FEW["random_forest"])
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    first, again = (sorted(scoring.batch_predict(rows, m).select("key", "a", "prediction", "churn_probability").collect()) for m in (model, loaded))
    assert first == again
    assert [r.a for r in first] == [r.a for r in sorted(rows.select("key", "a").collect())]


def test_boosting_ends_at_the_best_round_by_patience(spark, separable):
    rows = models.assemble(["a", "b"]).transform(separable).select("features", "label")
    noise = rows.withColumn("label", (F.rand(3) > 0.5).cast("double"))
    estimator, _ = models.model_for("xgboost", n_estimators=40, max_depth=2, learning_rate=0.5)
    fitted = models.fit_boosted(estimator, rows, noise, patience=3)
    whole = estimator.fit(rows)
    losses = whole.evaluateEachIteration(noise)
    best = fitted.getNumTrees - 1
    assert fitted.getNumTrees < 40 and losses[best] == min(losses[: best + 4])
    assert list(fitted.treeWeights) == list(whole.treeWeights)[: best + 1]
    assert fitted.transform(rows).count() == 240


def test_regression_metrics(spark, separable):
    rows = separable.withColumn("label", F.col("a") * 2 + 10)
    results, _ = models.train_all(rows, rows, ["a", "b"], task="regression", names=["random_forest"], overrides=FEW)
    assert results["random_forest"]["metrics"]["rmse"] < 2
    scored = scoring.batch_predict(rows, results["random_forest"]["model"], task="regression")
    assert "churn_probability" not in scored.columns


def test_holdout_is_stable_and_near_its_size(spark):
    rows = spark.range(5000).withColumn("key", F.col("id").cast("string"))
    one = {r.key for r in models.holdout_split(rows, ["key"]).filter("is_test").collect()}
    two = {r.key for r in models.holdout_split(rows.repartition(7), ["key"]).filter("is_test").collect()}
    assert one == two and 800 < len(one) < 1200


def test_cross_validation_scores_each_choice(spark, separable):
    fitted = models.cross_validate(
        separable, ["a", "b"], ["key"], folds=3, grid={"maxDepth": [1, 3]}, n_estimators=3
    )
    rows = models.fold_scores(spark, fitted).collect()
    assert [r.params for r in rows] == [{"maxDepth": "1"}, {"maxDepth": "3"}]
    assert all(0.5 < r.mean_metric <= 1 for r in rows)


def test_function_scoring(spark, separable):
    def load():
        return lambda matrix: matrix[:, 0] * 2

    out = scoring.predict_with_function(separable, ["a", "b"], load, batch_size=16)
    assert all(r.prediction == pytest.approx(2 * r.a) for r in out.collect())


def scores(spark, rows):
    return spark.createDataFrame([(float(s), float(y)) for s, y in rows], "score double, label double")


def test_auc_with_ties(spark):
    rows = [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.35, 1)]
    assert evaluate.roc_auc(scores(spark, rows), "score") == 0.75
    assert evaluate.roc_auc(scores(spark, [(0.1, 1), (0.2, 1)]), "score") is None


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1)), min_size=2, max_size=20))
def test_auc_is_the_share_of_ordered_pairs(spark, rows):
    positive, negative = [s for s, y in rows if y], [s for s, y in rows if not y]
    got = evaluate.roc_auc(scores(spark, rows), "score")
    if not positive or not negative:
        assert got is None
        return
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    assert got == pytest.approx(wins / len(positive) / len(negative), abs=6e-5)


def test_mape_of_a_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0)], "label double, prediction double")
    assert evaluate.mape(df).head().mape == 0.25
    assert evaluate.rmse(df).head().rmse == round(math.sqrt(0.5), 4)


def test_f1_counts_classes_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.0, 3.0)], "label double, prediction double")
    assert evaluate.f1_weighted(df).head().f1 == pytest.approx(0.8 * 2 / 4, abs=1e-4)
    assert evaluate.accuracy(df).head().accuracy == 0.5


def test_best_model_directions_and_missing_metrics(spark):
    runs = spark.createDataFrame(
        [("a", "a1", {"rmse": 3.0}), ("b", "b1", {"rmse": 1.0, "roc_auc": 0.5}), ("c", "c1", {"roc_auc": 0.9})],
        "model string, run string, metrics map<string,double>",
    )
    assert evaluate.best_model(runs, "rmse").head().model == "b"
    assert evaluate.best_model(runs, "roc_auc").head().model == "c"
    assert evaluate.best_model(runs, "f1").head().value is None


def test_forest_grown_in_parts(spark):
    rows = spark.range(400).selectExpr("double(id % 20) a", "double(id % 7) b", "double(id % 20 > 9) label", "id key")
    data = models.assemble(["a", "b"]).transform(rows).repartition(4)
    estimator, _ = models.model_for("random_forest", "classification", n_estimators=11, max_depth=4)
    fitted = models.fit_forest(estimator, data, fits=4)
    assert fitted.getNumTrees == 11 and len(fitted.trees) == 11
    assert fitted.transform(data).where("prediction <> label").count() == 0
    chances = [tree.predictProbability(data.first().features) for tree in fitted.trees]
    mean = sum(c.toArray() for c in chances) / 11
    assert abs(mean - fitted.predictProbability(data.first().features).toArray()).max() < 1e-9
    estimator, _ = models.model_for("random_forest", "regression", n_estimators=3, max_depth=4)
    fitted = models.fit_forest(estimator, data, fits=8)
    assert fitted.getNumTrees == 3
    value = data.first().features
    assert abs(fitted.predict(value) - sum(t.predict(value) for t in fitted.trees) / 3) < 1e-9


def test_boosting_grows_no_round_more_than_twice(spark, separable, monkeypatch):
    rows = models.assemble(["a", "b"]).transform(separable).select("features", "label")
    estimator, _ = models.model_for("xgboost", n_estimators=40, max_depth=2)
    assert not estimator.getCacheNodeIds() and models.model_for("random_forest")[0].getCacheNodeIds()
    grown, fit = [], type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, *a: (grown.append(self.getMaxIter()), fit(self, *a))[1])
    models.fit_boosted(estimator, rows, rows, patience=0 - 12)
    assert grown[0] < 40 and sum(grown) <= grown[0] + 40


def test_metrics_score_the_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def guess(x):
        made.add(1)
        return float(x % 2)

    rows = spark.range(100, numPartitions=2).select((F.col("id") % 3).cast("double").alias("label"), guess("id").alias("prediction"))
    metrics = evaluate.evaluate_model(rows.where("label < 2"))
    assert set(metrics) == {"accuracy", "f1"} and made.value <= 100
