"""Exact deduplication over a cuckoo-filter index of live digests.

:class:`CuckooIndex` keeps 16-bit fingerprints in two-choice buckets of four; beside every fingerprint the bucket
holds the content it stands for (full SHA-256 digest and a payload).  A fingerprint hit is verified against that
content, deletion removes one live digest, and an insertion that finds no room doubles the table and refills it from
the stored keys, so no key is ever lost and no answer is ever approximate.

The operator runs the index twice: per input partition, ``most_local`` digests at a time (which folds the copies of a hot text before anything is
shuffled, so a text that a third of all rows share sends a few rows per partition) and per digest shard, whose number
grows with the rows, so that one index stays within ``rows_per_shard`` digests.

Defined results: null text counts as empty; of equal texts the row with the largest doc_id stays (null ids rank lowest;
of repeated rows with one id exactly one stays); texts of any length are compared whole, by their SHA-256 digest; an empty table gives an empty result;
further columns pass through whatever their names.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, if_small, materialize

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Set of digests (bytes, at least 16) with payloads: insertion, verified lookup, deletion, resizing."""

    def __init__(self, capacity: int = 1024) -> None:
        self._make(max(2, 1 << math.ceil(math.log2(max(1, capacity) / SLOTS / 0.9 + 1))))
        self.size = 0
        self.resizes = 0

    def _make(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.cells: list[list | None] = [None] * (SLOTS * buckets)

    @staticmethod
    def _mark(digest: bytes) -> int:
        return int.from_bytes(digest[:2], "little") or 1

    def _first(self, digest: bytes) -> int:
        return int.from_bytes(digest[2:10], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, digest: bytes) -> int:
        """Slot of a live digest or -1: a fingerprint hit counts only if the bucket's content is the digest."""
        mark, one = self._mark(digest), self._first(digest)
        for bucket in (one, self._other(one, mark)):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.cells[slot][0] == digest:
                    return slot
        return -1

    def find(self, digest: bytes):
        """Payload of a live digest, else None."""
        slot = self._slot(digest)
        return None if slot < 0 else self.cells[slot][1]

    def __contains__(self, digest: bytes) -> bool:
        return self._slot(digest) >= 0

    def __len__(self) -> int:
        return self.size

    def _place(self, cell: list) -> list | None:
        """None if all found a place, else the cell that is left over."""
        mark = self._mark(cell[0])
        bucket = self._first(cell[0])
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.cells[slot] = mark, cell
                    return None
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (kick + mark) % SLOTS
            self.marks[slot], mark, self.cells[slot], cell = mark, self.marks[slot], cell, self.cells[slot]
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.cells[slot] = mark, cell
                    return None
        return cell

    def insert(self, digest: bytes, payload) -> None:
        """Add a digest that is not live yet; overflow doubles the table and refills it from the stored keys."""
        left = self._place([digest, payload])
        while left is not None:
            cells = [c for c in self.cells if c is not None] + [left]
            buckets = 2 * (self.mask + 1)
            left = None
            while True:
                self._make(buckets)
                self.resizes += 1
                if all(self._place(c) is None for c in cells):
                    break
                buckets *= 2
        self.size += 1

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest; False if it wasn't one."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.marks[slot], self.cells[slot] = 0, None
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((c[0], c[1]) for c in self.cells if c is not None)


GROUPS = "digest binary, keep_id long, keep_uid long, group_size long, tops long"
_ARROW = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_uid", pa.int64()), ("group_size", pa.int64()), ("tops", pa.int64())])


def _folder(most: int | None = None):
    """Merge rows (digest, keep_id, keep_uid, group_size, tops) of equal digest through one index.

    With ``most``, an index of that many digests is sent on and a new one begun, so memory is bounded whatever a partition holds; a later fold merges what
    is left.
    """

    def sent(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        rows = list(index.items())
        for at in range(0, len(rows), 50_000):
            part = rows[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], pa.binary())] + [pa.array([p[i] for _, p in part], pa.int64()) for i in (1, 2, 3, 4)], schema=_ARROW)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        least = -(1 << 63)
        for batch in batches:
            for digest, doc, uid, n, tops in zip(*(batch.column(i).to_pylist() for i in range(5))):
                key = least if doc is None else doc
                live = index.find(digest)
                if live is None:
                    if most is not None and len(index) >= most:
                        yield from sent(index)
                        index = CuckooIndex()
                    index.insert(digest, [key, doc, uid, n, tops])
                    continue
                live[3] += n
                if key == live[0]:
                    live[4] += tops
                    live[2] = max(live[2], uid)
                elif key > live[0]:
                    live[0], live[1], live[2], live[4] = key, doc, uid, tops
        yield from sent(index)

    return fold


def _digests(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"))


def dedup_groups(digests: DataFrame, rows_per_shard: int = 500_000, most_local: int = 200_000) -> DataFrame:
    """``(doc_id, uid, digest)`` rows to one row per digest: who stays, group size, rows that carry the top id."""
    one = F.lit(1).cast("long")
    local = digests.select("digest", F.col("doc_id").alias("keep_id"), F.col("uid").alias("keep_uid"), one.alias("group_size"), one.alias("tops")).mapInArrow(_folder(most_local), GROUPS)
    shards = max(int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(digests.count() / rows_per_shard))
    return local.repartition(shards, "digest").mapInArrow(_folder(), GROUPS)


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = materialize(_digests(docs).withColumn("uid", F.monotonically_increasing_id()), "digests")
    groups = dedup_groups(digests)
    return digests.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, most_sent: int = 400_000) -> DataFrame:
    """The documents that stay, with the columns of ``docs``.

    Only texts with copies are looked up: up to ``most_sent`` of them (some 40 MB) are broadcast, beyond that they are joined by a shuffle.
    """
    slim = materialize(_digests(docs).withColumn("uid", F.monotonically_increasing_id()), "digests")
    copies = materialize(dedup_groups(slim).filter("group_size > 1").select("digest", "keep_id", "tops"), "copies")
    repeated = not copies.filter("tops > 1").isEmpty()
    copies = if_small(copies, F.lit(0), most_sent)
    rows = _digests(docs, F.struct("*").alias("row")).join(copies, "digest", "left")
    alone = rows.filter(F.col("tops").isNull() | ((F.col("tops") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id")))).select("row.*")
    if not repeated:
        return alone
    # the same id and text more than once: one of the repeated rows stays
    again = rows.filter((F.col("tops") > 1) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = again.withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy(F.lit(0)))).filter("nth = 1")
    return alone.unionByName(first.select("row.*"))


def op7_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deduplication of all ``documents``."""
    return mark_duplicates(documents(spark, sf_dir))


ORACLE_OP7 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
