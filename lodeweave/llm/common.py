"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.sources.scratch import materialize, shared_dir

__all__ = ["WORD", "documents", "fold_of", "if_small", "materialize", "shared_dir", "small_batches", "source_key"]

#: Java regex of a word: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def source_key(source: Column) -> Column:
    """Never-null key of a source; null and the empty string stay apart."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def fold_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``: which fold a document is in (null id: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Lower the session's bound on the rows that are handed to Python at a time: texts are long, and a batch is held several times on its way."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def if_small(written: DataFrame, entries: Column, most: int) -> DataFrame:
    """A written table marked for broadcast if its rows and their entries are ``most`` at most, else as it is (to be joined by a shuffle)."""
    rows, inside = written.agg(F.count(F.lit(1)), F.coalesce(F.sum(entries), F.lit(0))).first()
    return F.broadcast(written) if rows + inside <= most else written
