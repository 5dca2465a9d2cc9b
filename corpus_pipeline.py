"""Corpus pipeline: quality, exact and near duplicates, source mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of ``documents``.

Defined results: a null text is scored and deduplicated as an empty one (and stays null if it stays), has no near duplicates, is not taken by the mixture
(its size is 0), and so is never packed; a null id is the smallest one for exact duplicates and the last choice for near ones; a null source is a source of
its own; a null lang changes nothing.  Texts have no length limit, and runs of one character take linear time.  Of equal texts the row with the largest id
stays, of near duplicates the smallest id; of rows that are equal in both, one stays.  Rows that repeat an id with unlike texts are documents of their own.
An empty table gives an empty result.  Further columns pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm import cuckoo, mixing, ngram_join, packing, quality
from lodeweave.llm.common import documents, fold_of, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model calls likelier good than bad; it learns from the training folds of ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels.filter(fold_of(F.col("doc_id"), 4) != 2)))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text: the one with the largest id."""
    return cuckoo.exact_dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents (five-word shingles, similarity 0.8)."""
    return ngram_join.drop_near_duplicates(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or dropped so that the sources meet their target weights."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing sources to target weights", mixture_stage),
    ("packing", packing_stage),
]
#: SQL cannot express the classifier or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
