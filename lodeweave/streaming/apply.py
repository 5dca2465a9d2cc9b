"""Structured Streaming: new batches of observations are applied to the versioned store as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodeweave.operators.store import Store

OBSERVATIONS = "subject string, predicate string, object string, method string, confidence double, time timestamp_ntz"


def apply_stream(spark: SparkSession, source: str, store: str, checkpoint: str, schema: str = OBSERVATIONS, files_per_batch: int = 100) -> StreamingQuery:
    """Watch a folder of Parquet batches; each micro-batch becomes one snapshot.  Runs until the folder is drained."""

    def apply(batch: DataFrame, _: int) -> None:
        Store.load(batch.sparkSession, store).apply(batch).save(store)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Observations per window and key with a watermark, for batch and streaming frames alike."""
    marked = stream.withWatermark(ts, late) if stream.isStreaming else stream
    return marked.groupBy(F.window(ts, window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")
