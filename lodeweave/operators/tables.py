"""Row operations on snapshot tables: every operation maps a table to its next version."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.functions.columns import clean_text
from lodeweave.operators.store import allocate_ids
from lodeweave.sources.scratch import materialize


def clean(rows: DataFrame) -> DataFrame:
    """NUL characters of all text columns replaced."""
    return rows.withColumns({c: clean_text(F.col(c)) for c, kind in rows.dtypes if kind == "string"})


def insert(table: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The table with new rows, and the rows with their ids (continued after the largest, in the order of a text key)."""
    new = allocate_ids(clean(rows), table, key)
    return table.unionByName(new, allowMissingColumns=True), new


def update(table: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Columns set where the condition holds."""
    return table.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def update_from(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns taken from the row of ``changes`` with the same keys, where there is one."""
    cols = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in cols), F.lit(True).alias("_hit"))
    joined = table.join(new, list(keys), "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in table.columns))


def delete(table: DataFrame, condition: Column) -> DataFrame:
    """Without the rows for which the condition is true."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def truncate(table: DataFrame) -> DataFrame:
    return table.limit(0)


class QueryLog:
    """Queries that are run at once, one or several, with statistics by their text."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.took: dict[str, list[float]] = {}

    def run(self, sql: str, tables: Mapping[str, DataFrame] | None = None, args: Mapping[str, object] | None = None) -> DataFrame:
        """The written result of a query; how long that took is kept."""
        began = time.monotonic()
        out = materialize(run_sql(self.spark, sql, tables, args), "query")
        self.took.setdefault(sql, []).append(time.monotonic() - began)
        return out

    def batch(self, queries: Sequence[tuple]) -> list[DataFrame]:
        """Results of (sql, tables, args), one after the other."""
        return [self.run(*q) for q in queries]

    def statistics(self) -> DataFrame:
        """(sql, runs, total_seconds, mean_seconds), the slowest in all first."""
        rows = sorted(((q, len(t), sum(t), sum(t) / len(t)) for q, t in self.took.items()), key=lambda r: -r[2])
        return self.spark.createDataFrame(rows, "sql string, runs int, total_seconds double, mean_seconds double")


def run_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None, args: Mapping[str, object] | None = None) -> DataFrame:
    """Parameterised query over named frames (``{name}`` for frames, ``:name`` for values)."""
    return spark.sql(sql, args=dict(args or {}), **dict(tables or {}))
