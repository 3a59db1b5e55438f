"""Tree model families on MLlib, training, holdout and cross-validation."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, fields, replace
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from brightwater.operators import boosting, evaluate, forest
from brightwater.session import ensure_checkpoint_dir

# Hyperparameter defaults of the three families.


@dataclass(frozen=True)
class BoostedConfig:
    """Level-wise boosting. MLlib has no L1/L2 leaf penalty, so none is listed."""

    n_estimators: int = 500
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_weight: int = 5
    random_state: int = 42


@dataclass(frozen=True)
class LeafwiseConfig:
    """Leaf-wise boosting, stood in for by depth: 2**6 = 64 leaves for 63."""

    n_estimators: int = 500
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_samples: int = 20
    random_state: int = 42


@dataclass(frozen=True)
class ForestConfig:
    """Random forest. MLlib stops at depth 30 and has no minimum split size."""

    n_estimators: int = 300
    max_depth: int = 30
    min_samples_leaf: int = 5
    max_features: str = "sqrt"
    random_state: int = 42


FAMILIES = {
    "xgboost": BoostedConfig(),
    "lightgbm": LeafwiseConfig(),
    "random_forest": ForestConfig(),
}
MODEL_NAMES = list(FAMILIES)


def model_for(
    name: str,
    task: str = "classification",
    features_col: str = "features",
    label_col: str = "label",
    **overrides: Any,
) -> tuple[Estimator, Any]:
    """Estimator and configuration of a family.

    Names ignore case, unknown overrides are ignored, and any task other than
    ``classification`` means regression.
    """
    if name.lower() not in FAMILIES:
        raise ValueError(f"Unknown model: {name!r} is none of {MODEL_NAMES}")
    default = FAMILIES[name.lower()]
    known = {f.name for f in fields(default)}
    config = replace(default, **{k: v for k, v in overrides.items() if k in known})
    classify = task == "classification"
    shared = dict(
        featuresCol=features_col,
        labelCol=label_col,
        seed=config.random_state,
        checkpointInterval=10,
        maxMemoryInMB=512,
        maxDepth=config.max_depth,
        # A deep tree is walked once a pass and kept as node ids; a shallow one is walked faster than ids are written.
        cacheNodeIds=isinstance(config, ForestConfig),
    )
    if isinstance(config, ForestConfig):
        kind = RandomForestClassifier if classify else RandomForestRegressor
        model = kind(
            numTrees=config.n_estimators,
            minInstancesPerNode=config.min_samples_leaf,
            featureSubsetStrategy=config.max_features,
            **shared,
        )
        return model, config
    least = config.min_child_weight if isinstance(config, BoostedConfig) else config.min_child_samples
    kind = GBTClassifier if classify else GBTRegressor
    model = kind(
        maxIter=config.n_estimators,
        stepSize=config.learning_rate,
        subsamplingRate=config.subsample,
        featureSubsetStrategy=str(config.colsample_bytree),
        minInstancesPerNode=least,
        **shared,
    )
    return model, config


def run_params(name: str, config: Any) -> dict[str, str]:
    """Hyperparameters for the run log, under the family's prefix."""
    prefix = {"xgboost": "xgb", "lightgbm": "lgbm", "random_forest": "rf"}[name.lower()]
    return {f"{prefix}_{key}": str(value) for key, value in asdict(config).items()}


def hash_bucket(keys: list[str], buckets: int, seed: int = 42) -> Column:
    """A bucket from the key's MD5: stable whatever the partitioning, even over keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def holdout_split(df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds boolean ``is_test``; a key always falls on the same side."""
    return df.withColumn("is_test", hash_bucket(keys, 10_000, seed) < int(round(test_size * 10_000)))


def assemble(columns: list[str], out: str = "features") -> VectorAssembler:
    """MLlib trees take no missing values: a row with one is an error, so prepare first."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error")


RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("task", T.StringType(), False),
        T.StructField("train_size", T.LongType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType(), True), False),
    ]
)


def fit_boosted(estimator: Estimator, rows: DataFrame, valid: DataFrame, patience: int = 50) -> Model:
    """Boosted trees up to the best round on ``valid``.

    Rounds stop when ``patience`` of them have brought no lower validation loss, or at
    the estimator's ``maxIter``. MLlib's own rule looks at one round only, so the trees are grown
    by :mod:`boosting`: a few rounds past the patience, then from there on up to ``maxIter``; no round is grown twice.
    """
    most = estimator.getMaxIter()
    few = boosting.grown(estimator, valid, patience)
    fitted = few.copy({few.maxIter: min(most, patience + 16)}).fit(rows)
    if not fitted.ended and fitted.getNumTrees < most:
        fitted = boosting.grown(estimator, valid, patience, before=fitted).fit(rows)
    return fitted.first_trees(fitted.losses.index(min(fitted.losses)) + 1)


def fit_forest(estimator: Estimator, rows: DataFrame, fits: int = 8, partition_rows: int = 100_000) -> Model:
    """One forest as an MLlib model, grown as ``fits`` smaller forests with seeds of their own, side by side.

    For forests whose nodes fit the driver; training uses :func:`forest.grow`, which keeps them as a table.

    A deep forest costs passes, not rows: each pass sends the statistics of every open node from every
    partition, and one pass waits for the other. So fits share the cores, and rows lie in partitions of
    ``partition_rows`` or more, as a partition with fewer rows than open nodes sends more statistics than
    rows; a table that is large already keeps its partitions. All trees have the estimator's parameters. Runs
    jobs; ``rows`` should be persisted or written.
    """
    count = estimator.getNumTrees()
    fits = min(fits, count)
    parts = rows.rdd.getNumPartitions()
    few = max(1, -(-rows.count() // partition_rows))
    packed = rows.coalesce(few) if few < parts else rows
    shares = [count // fits + (i < count % fits) for i in range(fits)]
    seeds = [estimator.getSeed() + i for i in range(fits)]

    def grow(share: int, seed: int) -> Model:
        return estimator.copy({estimator.numTrees: share, estimator.seed: seed}).fit(packed)

    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(fits) as pool:
            runs = [pool.submit(inheritable_thread_target(rows.sparkSession)(grow), n, s) for n, s in zip(shares, seeds)]
            grown = [run.result() for run in runs]
    finally:
        packed.unpersist()
    return joined_forest(estimator, grown)


def joined_forest(estimator: Estimator, forests: list[Model]) -> Model:
    """The trees of several forests as one model.

    MLlib offers no public way to make a forest of trees, so its constructor is called in the JVM:
    classic sessions only.
    """
    if len(forests) == 1:
        return forests[0]
    spark = SparkSession.getActiveSession()
    jvm, gateway = spark._jvm.org.apache.spark.ml, spark.sparkContext._gateway
    olds = [f._java_obj for f in forests]
    total = sum(f.getNumTrees for f in forests)
    classify = isinstance(forests[0], RandomForestClassificationModel)
    kind = jvm.classification.DecisionTreeClassificationModel if classify else jvm.regression.DecisionTreeRegressionModel
    trees = gateway.new_array(kind, total)
    at = 0
    for old in olds:
        for tree in old.trees():
            trees[at] = tree
            at += 1
    first = olds[0]
    if classify:
        new = jvm.classification.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), first.numClasses())
    else:
        new = jvm.regression.RandomForestRegressionModel(first.uid(), trees, first.numFeatures())
    joined = type(forests[0])(first.copyValues(new, jvm.param.ParamMap.empty()))
    joined._java_obj.set("numTrees", total)
    joined._java_obj.set("seed", estimator.getSeed())
    joined._resetUid(first.uid())
    joined._transfer_params_from_java()
    return joined


def train_all(
    train: DataFrame,
    valid: DataFrame,
    columns: list[str],
    label_col: str = "label",
    task: str = "classification",
    names: list[str] | None = None,
    overrides: dict[str, dict[str, Any]] | None = None,
    artifacts_dir: str | None = None,
    early_stopping: bool = False,
) -> tuple[dict[str, dict[str, Any]], DataFrame]:
    """Train each family and evaluate it on ``valid``.

    Returns per name the fitted model, its metrics and its saved path, and the
    run log as a table. Runs jobs; the assembled frames are persisted once and
    serve every family. With ``early_stopping`` the boosted families end at the best
    round on ``valid`` (see ``fit_boosted``). Names and overrides ignore case.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    keep = ["features", label_col]
    stage = assemble(columns)
    fit_rows = stage.transform(train).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    valid_rows = stage.transform(valid).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    chosen = {k.lower(): v for k, v in (overrides or {}).items()}
    results: dict[str, dict[str, Any]] = {}
    log = []
    try:
        size = fit_rows.count()
        for name in names or MODEL_NAMES:
            estimator, config = model_for(name, task, label_col=label_col, **chosen.get(name.lower(), {}))
            began = time.perf_counter()
            if isinstance(config, ForestConfig):
                fitted = forest.grow(estimator, fit_rows)
            else:
                fitted = fit_boosted(estimator, fit_rows, valid_rows) if early_stopping else boosting.grown(estimator).fit(fit_rows)
            seconds = time.perf_counter() - began
            metrics = evaluate.evaluate_model(fitted.transform(valid_rows), label_col, task)
            metrics["train_duration_sec"] = round(seconds, 2)
            model = PipelineModel([stage, fitted])
            path = None
            if artifacts_dir:
                path = f"{artifacts_dir}/{name}_{task}"
                save_model(model, path)
            results[name] = {"model": model, "metrics": metrics, "artifact_path": path}
            log.append((f"{name}_{task}", name, task, size, run_params(name, config), metrics))
    finally:
        fit_rows.unpersist()
        valid_rows.unpersist()
    return results, spark.createDataFrame(log, RUN_LOG_SCHEMA)


def cross_validate(
    df: DataFrame,
    columns: list[str],
    keys: list[str],
    name: str = "random_forest",
    label_col: str = "label",
    task: str = "classification",
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 2,
    grid: dict[str, list[Any]] | None = None,
    preparation: Pipeline | None = None,
    **overrides: Any,
) -> CrossValidatorModel:
    """k-fold cross-validation with folds fixed by the keys' hash.

    ``grid`` maps estimator parameter names (``maxDepth`` ...) to the values tried. A
    ``preparation`` is fitted anew inside each fold, on that fold's training rows;
    it must keep the label.
    """
    ensure_checkpoint_dir(df.sparkSession)
    model, config = model_for(name, task, label_col=label_col, **overrides)
    model = forest.grown(model) if isinstance(config, ForestConfig) else boosting.grown(model)
    if task == "classification":
        evaluator = MulticlassClassificationEvaluator(labelCol=label_col, metricName="f1")
    else:
        evaluator = RegressionEvaluator(labelCol=label_col, metricName="rmse")
    combos = ParamGridBuilder()
    for parameter, values in (grid or {}).items():
        combos.addGrid(model.getParam(parameter), values)
    validator = CrossValidator(
        estimator=Pipeline(stages=[*(preparation.getStages() if preparation else []), assemble(columns), model]),
        estimatorParamMaps=combos.build(),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    kept = df.withColumn("_fold", hash_bucket(keys, folds, seed)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return validator.fit(kept)
    finally:
        kept.unpersist()


def fold_scores(spark: SparkSession, fitted: CrossValidatorModel) -> DataFrame:
    """Average and spread of the metric over the folds, per parameter choice."""
    rows = []
    for params, mean, deviation in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics):
        rows.append(({p.name: str(v) for p, v in params.items()}, float(mean), float(deviation)))
    return spark.createDataFrame(rows, "params map<string,string>, mean_metric double, std_metric double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_with_preparation(
    df: DataFrame,
    preparation: Pipeline,
    columns: list[str],
    name: str,
    task: str,
    label_col: str = "label",
    valid: DataFrame | None = None,
    **overrides: Any,
) -> PipelineModel:
    """One model holding the preparation, the assembler and the trees.

    Reads ``df`` several times, so pass a table or a persisted frame. With
    ``valid`` rows boosting ends at the best round on them; the preparation learns from ``df`` alone.
    """
    ensure_checkpoint_dir(df.sparkSession)
    estimator, config = model_for(name, task, label_col=label_col, **overrides)
    stages = [*preparation.getStages(), assemble(columns)]
    if valid is None or isinstance(config, ForestConfig):
        grown = forest.grown(estimator) if isinstance(config, ForestConfig) else boosting.grown(estimator)
        return Pipeline(stages=[*stages, grown]).fit(df)
    before = Pipeline(stages=stages).fit(df)
    rows, held = (before.transform(x).select("features", label_col).persist(StorageLevel.MEMORY_AND_DISK) for x in (df, valid))
    try:
        return PipelineModel([*before.stages, fit_boosted(estimator, rows, held)])
    finally:
        rows.unpersist()
        held.unpersist()
