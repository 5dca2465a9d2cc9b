"""N-gram Jaccard join of documents with multiple-global-order filtering.

Candidates share a prefix token in the order of rarity (found by the join itself) and must share prefix tokens under
further token orders too; only the intersection of these filters is verified.  See :mod:`lodeweave.llm.setjoin` for the plan and its bounds.

Defined results: null and empty texts have an empty set and are linked with nothing; a text shorter than a shingle is one shingle; documents
with equal sets are linked; rows without an id are linked like all others (a component of such rows alone has no component_id); an empty table gives an empty result; repeated rows are documents of their own that share an id; texts of any length are compared whole; further
columns pass through :func:`drop_near_duplicates`, which keeps of each component the row with the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, if_small, materialize
from lodeweave.llm.setjoin import SetJoin
from lodeweave.llm.tokensets import Shingles, batches


def near_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, most_sent: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, set_id, component (of sets; null without words), component_id (smallest doc_id reachable by links)."""
    return _components(SetJoin(docs, Shingles(words), num, den, orders=2), most_sent)


def _components(join: SetJoin, most_sent: int) -> DataFrame:
    _, found = join.links()
    rows = join.table.select("doc_id", F.col("n").alias("n_shingles"), "set_id")
    # only sets that have links or copies are looked up; the hot ones of them are few rows a task here
    sets = rows.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows"))
    sets = sets.join(found.withColumnRenamed("id", "set_id"), "set_id", "left").filter("rows > 1 or component is not null")
    sets = materialize(sets.select("set_id", "low", F.coalesce("component", "set_id").alias("component")), "linked-sets")
    tops = materialize(sets.groupBy("component").agg(F.min("low").alias("component_id")), "tops")
    known = materialize(sets.join(if_small(tops, F.lit(0), most_sent), "component").select("set_id", "component", "component_id", F.lit(True).alias("linked")), "set-components")
    full = rows.join(if_small(known, F.lit(0), most_sent), "set_id", "left")
    return full.select(
        "doc_id",
        "n_shingles",
        "set_id",
        F.when(F.col("n_shingles") > 0, F.coalesce("component", "set_id")).alias("component"),
        F.when(F.col("linked").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, most_sent: int = 400_000) -> DataFrame:
    """One document of each component, with the columns of ``docs``; documents without words all stay.

    What goes is looked up, not what stays: up to ``most_sent`` sets (some 40 MB) are broadcast, beyond that they are joined by a shuffle.
    """
    kind = Shingles(words)
    join = SetJoin(docs, kind, num, den, orders=2)
    doubles = join.doubles

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for sets in batches(part.column(1), kind):
                yield pa.RecordBatch.from_arrays([part.column(0).slice(int(sets.owner[0]), len(sets.owner)), pa.array(sets.count), pa.array(sets.ids(doubles))], names=["row", "n_shingles", "set_id"])

    # rows that share an id, or have none, are told apart by their sets; a set stands in one component
    no_id = F.lit(-(1 << 63))
    found = _components(join, most_sent).filter("n_shingles > 0").withColumn("key", F.coalesce("doc_id", no_id))
    found = materialize(found.groupBy("key", "set_id").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("component")), "components")
    # the smallest id of each component, and of its sets the smallest; rows without an id come last
    first = found.groupBy("component").agg(F.min(F.struct(F.col("key") == no_id, "key", "set_id")).alias("first"))
    first = first.select("first.key", "first.set_id").withColumn("stays", F.lit(True))
    marked = found.join(first, ["key", "set_id"], "left")
    gone = materialize(marked.filter(~F.coalesce("stays", F.lit(False))).select("key", "set_id"), "gone")
    twice = materialize(marked.filter(F.col("stays") & (F.col("rows") > 1)).select("key", "set_id"), "repeated")
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).mapInArrow(sign, f"row {docs.schema.simpleString()}, n_shingles long, set_id long")
    rows = rows.withColumn("key", F.coalesce(F.col("row.doc_id").cast("long"), no_id))
    kept = rows.join(if_small(gone, F.lit(0), most_sent), ["key", "set_id"], "left_anti")
    if twice.isEmpty():
        return kept.select("row.*")
    # the same id and set more than once: one of the repeated rows stays
    again = kept.join(twice, ["key", "set_id"], "left_semi")
    one = again.withColumn("nth", F.row_number().over(Window.partitionBy("key", "set_id").orderBy(F.lit(0)))).filter("nth = 1")
    return kept.join(twice, ["key", "set_id"], "left_anti").select("row.*").unionByName(one.select("row.*"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` at 3-word shingles and similarity 0.9."""
    return near_components(documents(spark, sf_dir), 3, 90, 100).select("doc_id", "n_shingles", "component_id")
