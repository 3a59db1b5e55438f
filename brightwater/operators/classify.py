"""Document classification and triage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.functions import text as tx

# The labels and the confidence below which a person looks.
LABELS = ["compliance", "legal", "financial", "operational", "other"]
CONFIDENCE_THRESHOLD = 0.75


def classifier_input(docs: DataFrame, text: str = "text", max_words: int | None = None, normalize: bool = True) -> DataFrame:
    """Adds ``clean`` and its ``words``.

    A bag of words has no length limit, so the whole text counts;
    ``max_words=text.ENCODER_WORDS`` gives a fixed-width encoder's view.
    """
    clean = tx.clean_text(F.col(text), normalize=normalize)
    if max_words is not None:
        clean = tx.truncate_words(clean, max_words)
    return docs.withColumn("clean", clean).withColumn("words", tx.tokens(F.col("clean")))


def train_classifier(
    labelled: DataFrame,
    label_col: str,
    text: str = "text",
    num_features: int = 1 << 16,
    max_iter: int = 20,
    reg: float = 0.01,
    max_words: int | None = None,
    normalize: bool = True,
) -> PipelineModel:
    """Multinomial logistic regression on hashed term weights. Runs jobs.

    Rows without a label teach nothing and are left out.
    """
    known = labelled.where(F.col(label_col).isNotNull())
    rows = classifier_input(known, text, max_words, normalize).select(
        F.col(label_col).cast("string").alias("category"), "words"
    )
    indexer = StringIndexer(inputCol="category", outputCol="category_index", stringOrderType="alphabetAsc")
    counter = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features)
    stages = [
        indexer,
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(labelCol="category_index", family="multinomial", maxIter=max_iter, regParam=reg),
    ]
    # Term counts are kept, not words: a number for each different word of a text.
    kept = counter.transform(rows).select("category", "tf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        index, *rest = Pipeline(stages=stages).fit(kept).stages
    finally:
        kept.unpersist()
    return PipelineModel([index, counter, *rest])


def model_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def scoring_stages(model: PipelineModel) -> PipelineModel:
    """The model without the label indexer, which scoring has no column for."""
    return PipelineModel(model.stages[1:])


def label_scores(
    df: DataFrame, scores: Column, labels: list[str], clean: str = "clean", threshold: float = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """Label, confidence, review flag and score map from an array of probabilities.

    Review is decided on the unrounded confidence; the first label wins a tie.
    """
    names = F.array(*[F.lit(name) for name in labels])
    scored = df.withColumn("_scores", scores)
    best = F.array_max("_scores")
    return (
        scored.withColumn("text_snippet", tx.snippet(F.col(clean)))
        .withColumn("label", F.get(names, F.array_position("_scores", best).cast("int") - 1))
        .withColumn("confidence", F.round(best, 4))
        .withColumn("requires_review", best < threshold)
        .withColumn("all_scores", F.map_from_arrays(names, F.transform("_scores", lambda s: F.round(s, 4))))
        .drop("_scores")
    )


def classify_documents(
    docs: DataFrame,
    model: PipelineModel,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = CONFIDENCE_THRESHOLD,
    max_words: int | None = None,
    normalize: bool = True,
) -> DataFrame:
    ready = classifier_input(docs.select(doc_id, text), text, max_words, normalize)
    scored = scoring_stages(model).transform(ready)
    labelled = label_scores(scored, vector_to_array("probability"), model_labels(model), threshold=threshold)
    return labelled.select(doc_id, "text_snippet", "label", "confidence", "requires_review", "all_scores")


def triage(scored: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, confidence: str = "confidence") -> DataFrame:
    """Adds ``requires_review`` and the ``queue`` a document goes to."""
    review = F.col(confidence) < threshold
    return scored.withColumn("requires_review", review).withColumn(
        "queue", F.when(review, "review").otherwise("auto")
    )


def auto_triage(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(auto-approved, needs review)."""
    return classified.filter(~F.col("requires_review")), classified.filter("requires_review")


def automation_rate(classified: DataFrame) -> DataFrame:
    """Share of documents no person has to see; null for no documents."""
    return classified.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("requires_review")).alias("auto_approved"),
        F.count_if(F.col("requires_review")).alias("needs_review"),
        F.try_divide(F.count_if(~F.col("requires_review")), F.count(F.lit(1))).alias("automation_rate"),
    )


def classify_with(
    docs: DataFrame, score: Callable[[DataFrame], DataFrame], labels: list[str], text: str = "text", **options
) -> DataFrame:
    """Classify with a model from elsewhere.

    ``score`` gets the cleaned documents and adds the array column ``scores``,
    one probability per label (``predict_batch_udf`` gives it in batches).
    """
    ready = classifier_input(docs, text, **options)
    return label_scores(score(ready), F.col("scores"), labels).drop("scores", "words", "clean")
