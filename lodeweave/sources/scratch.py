"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that setting is absent, a temporary one in local mode (tests, notebooks), an error on a cluster."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodeweave-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed at exit, or when the block of :func:`scratch_space` around it ends."""
    path = f"{shared_dir(spark)}/lodeweave/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def _release(keep: int = 0) -> None:
    while len(_written) > keep:
        _forget(*_written.pop())


atexit.register(_release)


@contextlib.contextmanager
def scratch_space() -> Iterator[None]:
    """Scratch tables written inside the block are removed at its end; frames that read them must have been used up by then."""
    before = len(_written)
    try:
        yield
    finally:
        _release(before)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    except Exception:  # the JVM may be gone at exit; the folder is scratch space
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage, survives lost executors and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
