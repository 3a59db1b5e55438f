"""A corpus made ready for training: filtered, deduplicated, mixed and encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next stage's documents.
"""

from __future__ import annotations

import os
import string
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brightwater.llm import bpe, exact, minhash, mixing, quality  # noqa: E402
from brightwater.session import written  # noqa: E402

# Training learns from labels and hashes with seeds of its own, so SQL cannot give these rows.
ORACLE_SQL = None


def _kept(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents whose id the operator marks as kept: those with an id, dealt by it, and those without.

    The ids grow with the corpus, so they are merged at every size and never broadcast.
    """
    ids = written(found.where("kept").select(F.col("doc_id").alias("_kept_id")).distinct(), "kept")
    named = docs.where("doc_id IS NOT NULL").hint("merge").join(ids, F.col("doc_id") == F.col("_kept_id"), "left_semi")
    nameless = docs.where("doc_id IS NULL").hint("merge").join(ids, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
    return named, nameless


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _unused(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the largest id; of rows that repeat an id and a text, one.

    Rows are known by id and digest of the folded text, so texts move once, to the rows that stay, and rows
    without id are spread by their texts. Of rows that repeat both, the one least in its other columns stays.
    """
    kept = exact.exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    kept = written(kept, "kept")
    digest, order = _unused("_digest", docs.columns), _unused("_order", docs.columns)
    text = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    named = docs.withColumn(digest, F.sha2(text, 256))

    def met(rows: DataFrame) -> DataFrame:
        ids = rows.select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_digest"))
        return named.join(ids, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col(digest) == F.col("k_digest")), "left_semi")

    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id", digest).orderBy(*others, F.xxhash64("text"))
    repeated = met(written(kept.where("n > 1"), "repeated")).withColumn(order, F.row_number().over(first)).where(F.col(order) == 1)
    return met(kept.where("n = 1")).select(*docs.columns).unionByName(repeated.select(*docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 80 % of their five-word shingles: the smallest id."""
    named, nameless = _kept(docs, minhash.near_components(docs).select("doc_id", "kept"))
    return named.unionByName(nameless)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix of sources takes them, in the order of its schedule."""
    return mixing.mixed_documents(docs, whole=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; ``text`` is what the ids decode to.

    The ids are written before they are decoded: two Python steps in one stage take two workers a core, which stay
    alive with their memory while the next stages run.
    """
    ranks, pattern = bpe.multilingual()
    ids = written(bpe.encode(docs, ranks, pattern).drop("text"), "ids")
    coded = bpe.decode(ids, ranks)
    return coded.withColumns({"text": F.decode("decoded", "utf-8"), "n_tokens": F.size("ids").cast("long")}).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
