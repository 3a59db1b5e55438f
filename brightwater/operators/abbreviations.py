"""Abbreviations learned from a corpus, and sentences that do not end at them.

After Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection" (2006): a word that carries its full stop
far more often than words do by chance, is short, and seldom stands without one is an abbreviation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwater.functions import text as tx
from brightwater.session import written

EDGES = r"""^[("'\[]+|[,;:)"'\]]+$"""
WORD_FORM = r"^\p{L}+(\.\p{L}+)*\.?$"

# Fixed values of the paper: the least score of an abbreviation, how sure its stop is.
LEAST_SCORE = 0.3
SURE = 0.99


def _pieces(text: Column) -> Column:
    """Pieces between white space, without brackets, quotes and commas at their edges."""
    return F.transform(F.split(text, f"{tx.SPACE}+"), lambda p: F.regexp_replace(p, EDGES, ""))


def _bare(piece: Column) -> Column:
    return F.lower(F.regexp_replace(piece, r"\.$", ""))


def word_types(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, stops, plain, small``: how often each word has a full stop, has none, begins in lower case.

    One combined aggregate over the exploded words, so a frequent word is no one task's work. Null texts have no words.
    """
    pieces = docs.select(F.explode(_pieces(F.col(text))).alias("piece")).where(F.col("piece").rlike(WORD_FORM))
    return pieces.groupBy(_bare(F.col("piece")).alias("word")).agg(
        F.count_if(F.col("piece").endswith(".")).alias("stops"),
        F.count_if(~F.col("piece").endswith(".")).alias("plain"),
        F.count_if(F.col("piece").rlike(r"^\p{Ll}")).alias("small"),
    )


def abbreviations(types: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``word, stops, plain, score`` of the words that score ``least`` or more; ``types`` is from :func:`word_types`.

    A short word that the corpus has only at the end of sentences scores like one.

    The score is Dunning's log-likelihood ratio of "the stop comes as often as on any word" against "nearly always",
    times e to the minus number of letters, times one more than the inner stops, over the letters to the power of
    the occurrences without stop. Runs a job for the two totals; ``types`` should be written. No word with a stop, or none
    without, gives no rows.
    """
    total = types.agg(F.sum("stops").alias("s"), F.sum("plain").alias("p")).first()
    if not total["s"] or not total["p"]:
        return types.select("word", "stops", "plain", F.lit(0.0).alias("score")).where("false")
    chance = total["s"] / (total["s"] + total["p"])
    by_chance = F.col("stops") * F.log(F.lit(chance)) + F.col("plain") * F.log(F.lit(1 - chance))
    as_sign = F.col("stops") * F.log(F.lit(SURE)) + F.col("plain") * F.log(F.lit(1 - SURE))
    letters = F.length(F.translate("word", ".", "")).cast("double")
    inner = F.length("word") - letters
    score = -2 * (by_chance - as_sign) * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("plain").cast("double"))
    return types.where("stops > 0").select("word", "stops", "plain", score.alias("score")).where(F.col("score") >= least)


def learned_sentences(
    docs: DataFrame, types: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, position, sentence``: as ``sentence_rows``, but an abbreviation does not end a sentence.

    Except where the next word begins with a capital and the corpus writes it in lower case too: then it is a
    sentence's first word. Parts of a sentence are joined by one space. ``doc_id`` must be unique; a null or empty text gives
    no rows. Both tables of words grow with the vocabulary, so they are joined, not sent along; sentences
    are shuffled by document once, and a document's are ordered in one task.
    """
    parts = docs.select(F.col(doc_id).alias("_id"), tx.sentences(F.col(text)).alias("_parts"))
    rows = parts.select("_id", F.posexplode("_parts").alias("_at", "_part"), F.col("_parts"))
    last = F.element_at(_pieces(F.col("_part")), -1)
    first = F.element_at(_pieces(F.get("_parts", F.col("_at") + 1)), 1)
    ends = rows.select(
        "_id",
        "_at",
        "_part",
        F.when(last.rlike(WORD_FORM) & last.endswith("."), _bare(last)).alias("_last"),
        F.when(first.rlike(r"^\p{Lu}"), _bare(first)).alias("_next"),
    )
    short = found.select(F.col("word").alias("_last"), F.lit(True).alias("_short"))
    starts = types.where("small > 0").select(F.col("word").alias("_next"), F.lit(True).alias("_starts"))
    met = ends.join(short, "_last", "left").join(starts, "_next", "left")
    flagged = met.withColumn("_on", F.col("_short").isNotNull() & F.col("_starts").isNull())
    order = Window.partitionBy("_id").orderBy("_at")
    fresh = F.when(F.lag("_on").over(order), 0).otherwise(1)
    numbered = flagged.withColumn("_fresh", fresh).withColumn("_no", F.sum("_fresh").over(order) - 1)
    whole = numbered.groupBy("_id", "_no").agg(F.array_sort(F.collect_list(F.struct("_at", "_part"))).alias("_all"))
    return whole.select(
        F.col("_id").alias(doc_id), F.col("_no").cast("int").alias("position"), F.array_join("_all._part", " ").alias("sentence")
    )


def sentences_without_abbreviations(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn abbreviations from ``docs`` and cut the same texts by them. Runs jobs and writes the word counts."""
    types = written(word_types(docs, text), "word-types")
    return learned_sentences(docs, types, abbreviations(types), doc_id, text)
