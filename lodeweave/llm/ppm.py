"""Language identification by prediction by partial matching.

For each language a variable-order context tree over bytes counts what follows every context of up to ``ORDER`` bytes.
After fitting the statistics are frozen: a byte's probability is its share in the longest known context that has seen it, times
the escape probabilities (method C: distinct successors against occurrences) of the longer contexts that have not.  A text's score in a language is
its exact code length, the sum of ``-log2`` of these probabilities over all its bytes, and the shortest code names the language.

Trees are stored as sorted arrays (context and byte packed in one integer), so the code lengths of a batch are found for its distinct byte
strings with a few vectorised searches; a text is worked on ``CHUNK`` bytes at a time, so beside the text itself its length costs no memory.

Models are fitted on at most ``max_rows`` rows a language, in order of a hash of the id, and on no more of these once they hold ``max_bytes`` bytes (documented
bounds of the sample of labelled rows); a tree keeps every context it saw.

Defined results: null text, or text without a letter, is ``und`` with score 0; without any training language everything is ``und``;
ties go to the language first in code point order; texts of any length are scored whole; repeated rows are scored each and alike, and a row that the
sample holds twice trains once; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, fold_of, small_batches

ORDER = 4
CHUNK = 1 << 20
PAD = b"\n" * ORDER


@dataclass
class Tree:
    """Per order k: packed strings of k + 1 bytes with code lengths of their last byte, and contexts of k bytes with escape costs (bits)."""

    strings: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def code_lengths(self, packed: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each packed string of ORDER + 1 bytes."""
        total = np.zeros(len(packed))
        open_ = np.arange(len(packed))
        for k in range(ORDER, -1, -1):
            keys = packed[open_] & ((1 << (8 * (k + 1))) - 1)
            found, at = _find(self.strings[k], keys)
            total[open_[found]] += self.costs[k][at[found]]
            open_, keys = open_[~found], keys[~found]
            if k:
                known, at = _find(self.contexts[k], keys >> 8)
            else:
                known, at = np.ones(len(open_), bool), np.zeros(len(open_), np.int64)
            total[open_[known]] += self.escapes[k][at[known]]
        total[open_] += 8.0  # a byte never seen: uniform
        return total


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


def pack(data: bytes, before: bytes = PAD) -> np.ndarray:
    """For each byte the integer of it and the ORDER bytes before it."""
    b = np.frombuffer(before + data, np.uint8).astype(np.int64)
    n = len(data)
    out = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        out |= b[ORDER - k : ORDER - k + n] << (8 * k)
    return out


def packed_chunks(data: bytes) -> Iterator[np.ndarray]:
    """:func:`pack` of a text, CHUNK bytes at a time."""
    for a in range(0, len(data), CHUNK):
        yield pack(data[a : a + CHUNK], data[a - ORDER : a] if a else PAD)


def fit(texts: list[bytes]) -> Tree:
    """Count and freeze."""
    packed = np.concatenate([pack(t) for t in texts]) if texts else np.empty(0, np.int64)
    strings, costs, contexts, escapes = [], [], [], []
    for k in range(ORDER + 1):
        keys, n = np.unique(packed & ((1 << (8 * (k + 1))) - 1), return_counts=True)
        heads, at = np.unique(keys >> 8, return_inverse=True)
        total, distinct = np.bincount(at, n, len(heads)), np.bincount(at, minlength=len(heads))
        strings.append(keys)
        costs.append(np.log2((total + distinct)[at] / n) if len(keys) else np.empty(0))
        contexts.append(heads)
        escapes.append(np.log2((total + distinct) / np.maximum(distinct, 1)) if len(heads) else np.zeros(1))
    return Tree(strings, costs, contexts, escapes)


def train(docs: DataFrame, max_rows: int = 250, max_bytes: int = 1_500_000) -> dict[str, Tree]:
    """A tree for each language of ``docs`` (doc_id, text, lang), fitted on whole texts.

    The rows with the smallest hash of the id are taken, at most ``max_rows`` a language; the rank filter prunes within each task before anything is
    shuffled.  Rows after the one with which a language reaches ``max_bytes`` are left out, so the driver gets no more than that and one text a language.
    """
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("text_key"), F.octet_length("text").alias("bytes"), "text")
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text_key")
    ranked = rows.drop("text").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= max_rows)
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("lang").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = ranked.withColumn("before", before).filter(F.col("before") < max_bytes).select("lang", "h", "text_key").distinct()
    some = rows.join(F.broadcast(chosen), ["lang", "h", "text_key"]).groupBy("lang", "h", "text_key").agg(F.first("text").alias("text"))
    out: dict[str, Tree] = {}
    for lang, part in sorted(some.toPandas().sort_values(["h", "text_key"]).groupby("lang"), key=lambda x: x[0]):
        out[str(lang)] = fit([t.encode("utf-8", "surrogatepass") for t in part["text"]])
    return out


def code_lengths(texts: Iterable[bytes], trees: list[Tree], n: int | None = None) -> np.ndarray:
    """Bits of each of ``n`` texts in each language; works through the texts' bytes in chunks of CHUNK."""
    out = np.zeros((len(texts) if n is None else n, len(trees)))
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held:
            grams = np.concatenate([g for _, g in held])
            distinct, at = np.unique(grams, return_inverse=True)
            first = np.concatenate([[0], np.cumsum([len(g) for _, g in held])[:-1]])
            rows = np.array([i for i, _ in held])
            for j, tree in enumerate(trees):
                np.add.at(out[:, j], rows, np.add.reduceat(tree.code_lengths(distinct)[at], first))
            held.clear()

    size = 0
    for i, t in enumerate(texts):
        for packed in packed_chunks(t):
            held.append((i, packed))
            size += len(packed)
            if size >= CHUNK:
                flush()
                size = 0
    flush()
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _identifier(models: dict[str, Tree]):
    names, trees = list(models), list(models.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 256) for a in range(0, batch.num_rows, 256)):
                texts = part.column(1)
                clear = [bool(names) and has_letter(t.as_py()) for t in texts]
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                if any(clear):
                    bits = code_lengths((t.as_py().encode("utf-8", "surrogatepass") if c else b"" for t, c in zip(texts, clear)), trees, len(texts))
                    best = bits.argmin(1)
                    share = 1 / np.exp2(-np.clip(bits - bits.min(1)[:, None], 0, 60)).sum(1)
                    for i, c in enumerate(clear):
                        if c:
                            langs[i], scores[i] = names[best[i]], share[i]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, models: dict[str, Tree]) -> DataFrame:
    """doc_id, lang_pred, score (the posterior of the best language at equal priors) for every document."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_identifier(models), "doc_id long, lang_pred string, score double")


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by the models of the training folds."""
    docs = documents(spark, sf_dir)
    models = train(docs.filter(fold_of(F.col("doc_id"), 4) != 2))
    return identify(docs, models).select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
