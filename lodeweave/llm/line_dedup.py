"""Line deduplication by an exact set-similarity join.

A line is the set of its words.  Words are ordered by rarity, lines that may be similar share prefix words and pass the length and
positional filters, and Jaccard similarity is verified on whole lines (:mod:`lodeweave.llm.linejoin`).  A line is removed if it is similar to a line at an
earlier place, whether or not that one stays; a line that is only linked to an earlier one by later lines stays.

Places are ordered by doc_id, null ids first, then by a hash of the row, then by line number.

Defined results: lines without words always stay; lines of fewer words than the threshold leaves room for one other word (four at 0.8) match only lines
with equal sets; null text has no lines and stays null; rows without an id, or that share one, are rows of their own: each loses its own lines
alone, and of equal rows one keeps its lines; texts and lines of any length are compared whole; an empty table gives an empty result; further columns pass
through :func:`drop_lines` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import WORD, documents, if_small, materialize
from lodeweave.llm.linejoin import LineJoin


def line_classes(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """One row per line with words: doc_id, line, class_doc, class_line (the first line of its connected component of matches)."""
    found = LineJoin(docs, num, den).classes()
    return found.select(F.col("doc").alias("doc_id"), F.col("line").cast("long").alias("line"), F.col("top.doc").alias("class_doc"), F.col("top.line").cast("long").alias("class_line"))


def _marked(join: LineJoin, most_sent: int = 1_000_000) -> DataFrame:
    """row, removed (sorted line numbers, null for none) of every row; broadcast up to ``most_sent`` entries (some 20 MB).

    Rows that are equal in all columns are one up to here: they are counted (combined within each task), and all but one lose every line with words.
    """
    gone = join.removed().groupBy(F.col("uid").alias("at"), F.col("doc").alias("at_doc")).agg(F.array_sort(F.collect_set(F.col("line").cast("long"))).alias("removed"))
    gone = if_small(materialize(gone, "removed"), F.size("removed"), most_sent)
    there = (F.col("uid") == F.col("at")) & F.col("doc").eqNullSafe(F.col("at_doc"))
    repeated = join.repeated()
    if repeated.isEmpty():
        return join.rows.join(gone, there, "left").select("row", "removed")
    repeated = if_small(repeated.select(F.col("uid").alias("again"), F.col("doc").alias("again_doc")), F.lit(0), most_sent)
    more = (F.col("uid") == F.col("again")) & F.col("doc").eqNullSafe(F.col("again_doc"))
    single = join.rows.join(repeated, more, "left_anti").join(gone, there, "left").select("row", "removed")
    groups = join.rows.join(repeated, more, "left_semi").groupBy("uid", "doc").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("n"))
    lines = F.split(F.coalesce(F.col("row.text").cast("string"), F.lit("")), "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(WORD), i.cast("long"))), lambda i: i.isNotNull())
    copies = groups.join(gone, there, "left").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return single.unionByName(copies.select("row", F.when(F.col("nth") == 1, F.col("removed")).otherwise(worded).alias("removed")))


def removed_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, removed (sorted line numbers), one row for each row that loses lines."""
    return _marked(LineJoin(docs, num, den)).filter(F.size("removed") > 0).select(F.col("row.doc_id").alias("doc_id"), "removed")


def without_lines(text: str | None, removed: list[int] | None) -> str | None:
    """The text without the given lines."""
    if text is None or not removed:
        return text
    gone = set(removed)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def drop_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without their later similar lines, with the columns of ``docs``."""
    kind = dict(docs.dtypes)["text"]

    def cut(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, gone in texts:
            yield pd.Series([without_lines(t, None if g is None else list(g)) for t, g in zip(text, gone)])

    strip = F.pandas_udf(cut, kind)
    return _marked(LineJoin(docs, num, den)).select(F.col("row").withField("text", strip(F.col("row.text"), F.col("removed"))).alias("row")).select("row.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its lines that stay and go, and a digest of the text that is left."""
    marked = _marked(LineJoin(documents(spark, sf_dir).select("doc_id", "text")))
    rows = marked.select("row.doc_id", F.split(F.coalesce("row.text", F.lit("")), "\n").alias("lines"), "removed")
    kept = F.filter("lines", lambda x, i: ~F.array_contains("removed", i.cast("long")))
    left = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(kept)
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        F.sha2(F.array_join(left, "\n"), 256).alias("left_sha256"),
    )
