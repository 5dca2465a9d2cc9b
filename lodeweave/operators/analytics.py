"""Exploration reports: counts, frequencies, histograms, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def distinct_subjects(triples: DataFrame) -> DataFrame:
    return triples.agg(F.countDistinct("s").alias("n_subjects"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def type_frequency(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.lower(F.trim(F.coalesce(F.col(col), F.lit("")))).alias(col)).agg(F.count(F.lit(1)).alias("n"))


def tag_frequency(df: DataFrame, tags: str) -> DataFrame:
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def monthly(df: DataFrame, created: str, modified: str) -> DataFrame:
    """Per month of creation: rows, rows modified later, rows never modified."""
    changed = (F.col(created) != F.col(modified)).cast("long")
    return df.groupBy(F.date_format(created, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("created"), F.sum(changed).alias("modified"), F.sum(1 - changed).alias("untouched"))


def cumulative(df: DataFrame, ts: str, unit: str = "month") -> DataFrame:
    """Rows so far at the end of each month; counted before the running sum, so the window sees one row a month."""
    per = df.groupBy(F.date_format(ts, "yyyy-MM" if unit == "month" else "yyyy-MM-dd").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("total", F.sum("n").over(Window.orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def anomalies(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose later time lies before the earlier one, and on how many days."""
    return df.filter(F.col(later) < F.col(earlier)).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.to_date(F.col(earlier))).alias("days"))


def size_report(df: DataFrame, size: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Sum and mean in units of 10^9."""
    return df.groupBy(*keys).agg((F.sum(size) / 1e9).alias("sum_g"), (F.avg(size) / 1e9).alias("mean_g"))
