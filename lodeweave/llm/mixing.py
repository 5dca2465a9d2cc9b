"""Mixing sources to target weights by systematic sampling (DataFrame operations only).

Each source gets a token budget (:func:`source_targets`).  A document's expected number of copies is
``target / source_size``; within a source the documents stand in one total order, their expected copies are
summed up, one offset is added, and a document is emitted once for each integer boundary its interval crosses.
The order puts documents of like size side by side, so the words taken follow the copies taken; inside a size it goes by a digest of id and text.

Scale: prefix sums come from counts per (source, size class, shard) plus a rank inside such a cell, so a source
with a third of all rows is dealt over ``shards`` times its size classes, and no window holds a whole source; repeated and missing ids are dealt
by their texts.  Only the table of sources (a row each) is ordered in one task.

Defined results: null text has size 0; a null source is a source of its own, ordered last; a source whose size is 0
is not taken; texts of any length are counted whole; an empty table gives an empty result; repeated rows are independent documents (which of equal rows
is taken more often is left open); further columns are passed through :func:`mix` whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import WORD, documents, materialize, source_key


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[int] = (3, 1, 2)) -> DataFrame:
    """``(key, source, source_size)`` to the same with ``target``: one row per source.

    ``share`` of all sizes is split by weight; no target exceeds ``cap`` times its source, and the excess is shared
    again by weight.  The fixed point is a water level: with sources ordered by cap per weight, the level is the
    largest of ``(budget - caps before) / weights from here on``.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("before", F.coalesce(F.sum("most").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("budget") - F.col("before")) / F.col("left")).over(everything))
        .select("key", "source", "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"))
    )


def _plan(docs: DataFrame, counts: DataFrame, share: float, cap: float, weights: Sequence[int], seed: int) -> DataFrame:
    """docs: key, source, size, cell columns and a tie key; counts: the same cells with n and words."""
    sizes = counts.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    targets = source_targets(sizes, share, cap, weights)
    ahead = Window.partitionBy("key").orderBy("size_class", "shard").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("key", "size_class", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    cells = cells.join(targets.drop("source"), "key").withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    # a multiple of 2^-16, so that offset plus prefix stays exact for whole rates
    cells = cells.withColumn("start", _digits(F.concat(F.lit(f"{seed} "), F.col("key")), 4) / F.lit(float(1 << 16)))
    inside = Window.partitionBy("key", "size_class", "shard").orderBy("size", "tie")
    ranked = docs.withColumn("rank", F.row_number().over(inside).cast("long"))
    at = F.col("base") + F.col("rank")
    crossed = F.floor(F.col("start") + F.col("rate") * at) - F.floor(F.col("start") + F.col("rate") * (at - 1))
    return ranked.join(cells, ["key", "size_class", "shard"]).withColumn("copies", F.least(crossed, F.ceil("rate")).cast("int"))


def _digits(value: Column, n: int) -> Column:
    """The first hex digits of a text's MD5 digest, as a number."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, n), 16, 10).cast("long")


def _tie(docs: DataFrame) -> Column:
    return _digits(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(" "), F.coalesce(docs["text"].cast("string"), F.lit(""))), 15)


def _cells(docs: DataFrame, shards: int) -> DataFrame:
    """Eight size classes to each doubling of a size."""
    bits = F.length(F.bin(F.col("size") + 1))
    size_class = bits * 8 + F.expr("shiftright(size + 1, greatest(length(bin(size + 1)) - 4, 0))").bitwiseAND(F.lit(7))
    return docs.withColumn("size_class", size_class.cast("int")).withColumn("shard", (F.col("tie") % shards).cast("int"))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.groupBy("key", "size_class", "shard").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))


def plan_mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[int] = (3, 1, 2), seed: int = 17, shards: int = 64) -> DataFrame:
    """What a mix takes of each document, without moving texts.

    Returns doc_id, source, size, source_size, target, copies (0 to ``cap``), taken (words, repeats counted).
    The few bytes of each document that the plan needs are written once, so texts are read and counted once.
    """
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), _tie(docs).alias("tie"))
    slim = materialize(slim.withColumn("key", source_key(F.col("source"))), "mix-sizes")
    slim = _cells(slim, shards)
    return _plan(slim, _counted(slim), share, cap, weights, seed).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[int] = (3, 1, 2), seed: int = 17, shards: int = 64) -> DataFrame:
    """The mixed documents themselves: every row as often as it is taken, with the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"), source_key(F.col("source")).alias("key"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), _tie(docs).alias("tie"))
    rows = _cells(rows, shards)
    taken = _plan(rows, _counted(rows.drop("row")), share, cap, weights, seed).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the production weights."""
    return plan_mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


#: Sources' targets by water level, then one systematic pass over each source in the order of size class, shard, size and digest.
ORACLE_OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')), 1, 15))::BIGINT AS tie
  FROM documents
), s AS (
  SELECT key, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY key
), w AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM s
), r AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (ORDER BY most / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining
  FROM w
), t AS (
  SELECT key, source_size, least(most, max((budget - before) / remaining) OVER () * weight) AS target,
         ('0x' || substr(md5('17 ' || key), 1, 4))::BIGINT / 65536.0::DOUBLE AS start
  FROM r
), c AS (
  SELECT d.*, t.source_size, t.target, t.start, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.key ORDER BY length(bin(size + 1)) * 8 + (((size + 1) >> greatest(length(bin(size + 1)) - 4, 0)) & 7), tie % 64, size, tie) AS k
  FROM d JOIN t USING (key)
)
SELECT doc_id, size, source_size, target, (least(floor(start + rate * k) - floor(start + rate * (k - 1)), ceil(rate)) * size)::BIGINT AS taken FROM c
"""
