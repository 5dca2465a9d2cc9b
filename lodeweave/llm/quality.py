"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic gradient boosting with shallow trees: round after round, every feature in turn gets one small tree (at most
``LEAVES`` leaves over its bins), whose values are added to that feature's lookup table; then the feature pairs that explain most of what is left
get two-dimensional tables the same way.  A text is scored by looking its bins up and adding: one vectorised pass over
all documents, no model object beyond a few kilobytes of tables.

Features are computed on the whole text alone.  The model is fitted on at most ``max_rows`` labelled rows of the training
folds (the rows with the smallest hash of the id; a documented bound), and everything else covers all rows.

Defined results: null and empty texts are scored like a text without words; a text of any length is scored whole in time that grows with its
length; a null or missing label is no training row; without two classes in the training rows every score is the share of label 1 (0.5 without
rows); labels that contradict each other are training rows each, repeated ones count once; repeated rows are scored each and alike; an empty table gives an empty
result; further columns pass through :func:`keep_good` whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, fold_of, small_batches

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "upper", "digits", "symbols", "punctuation", "odd_ends", "bars", "bangs",
    "spaces", "line_words", "line_repeats", "distinct_words", "top_word", "repeat_pairs", "letters", "sentence_words", "entropy", "title_words", "other_bytes", "marks", "runs",
)
LEAVES = 3
_SPACES = re.compile(r"\s+")
_RUNS = re.compile(r"(.)\1{3,}", re.S)
#: A run of odd symbols before white space; it begins where its run does and gives nothing back, so long runs take linear time.
_ODD = r"""[^\w\s.,;:!?'")\]]"""
_ODD_END = re.compile(rf"(?<!{_ODD}){_ODD}++(?=\s|$)")


def features(text: str | None) -> list[float]:
    """Numbers that describe the whole text; see ``FEATURES``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    hist = np.bincount(raw, minlength=256)
    words = text.split()
    k = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    lower, upper = int(hist[97:123].sum()), int(hist[65:91].sum())
    digits, other = int(hist[48:58].sum()), int(hist[128:].sum())
    white = int(hist[9:14].sum() + hist[32])
    plain = int(hist[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    symbols = n - lower - upper - digits - other - white - plain if len(raw) else 0
    share = hist[hist > 0] / n
    ends = int(hist[[33, 46, 63]].sum())
    pairs = set(zip(words, words[1:]))
    return [
        np.log1p(len(text)), np.log1p(len(words)), len(text) / k, sum(len(w) > 14 for w in counts) / max(1, len(counts)), upper / max(1, upper + lower), digits / n, symbols / n, plain / n,
        len(_ODD_END.findall(text)) / k, int(hist[124]) / k, int(hist[33]) / k, white / n, len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(counts) / k, max(counts.values(), default=0) / k, 1 - len(pairs) / max(1, len(words) - 1), (lower + upper + other) / n, len(words) / max(1, ends), float(-(share * np.log2(share)).sum()),
        sum(w[:1].isupper() for w in words) / k, other / n, ends / k, sum(len(m.group()) for m in _RUNS.finditer(text)) / n,
    ]


@dataclass
class Gam:
    """Bin edges and lookup tables by feature, tables by feature pair, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _tree(gradient: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Values by bin of a tree of at most LEAVES leaves over ordered bins: best splits first, Newton steps in the leaves."""
    leaves = [(0, len(gradient))]
    g, h = np.concatenate([[0.0], gradient.cumsum()]), np.concatenate([[0.0], weight.cumsum()])
    gain_of = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)
    for _ in range(LEAVES - 1):
        best = (1e-9, None, None)
        for leaf in leaves:
            a, b = leaf
            cut = np.arange(a + 1, b)
            if len(cut):
                gain = gain_of(a, cut) + gain_of(cut, b) - gain_of(a, b)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (float(gain[i]), leaf, int(cut[i]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for a, b in leaves:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 8, bins: int = 48, pair_bins: int = 8, rate: float = 0.15, penalty: float = 2.0) -> Gam:
    """Boost the main effects cyclically, pick pairs by the gain of their residual tables, boost those."""
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return Gam([np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), intercept=float(np.log(share / (1 - share))))
    d = x.shape[1]
    model = Gam([_edges(x[:, j], bins) for j in range(d)], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_edges(x[:, j], pair_bins) for j in range(d)]
    model.intercept = float(np.log(y.mean() / (1 - y.mean())))
    at = model.bins(x)
    total = np.full(len(y), model.intercept)
    residual = lambda: (y - (p := 1 / (1 + np.exp(-np.clip(total, -30, 30)))), p * (1 - p))
    for _ in range(rounds):
        for j in range(d):
            r, w = residual()
            size = len(model.tables[j])
            step = rate * np.clip(_tree(np.bincount(at[:, j], r, size), np.bincount(at[:, j], w, size), penalty), -3, 3)
            model.tables[j] += step
            total += step[at[:, j]]
    coarse = np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)])
    r, w = residual()
    gains = []
    for a in range(d):
        for b in range(a + 1, d):
            cell, size = coarse[:, a] * (pair_bins + 1) + coarse[:, b], (pair_bins + 1) ** 2
            g, h = np.bincount(cell, r, size), np.bincount(cell, w, size)
            gains.append((float((g**2 / (h + penalty)).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:n_pairs]]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            r, w = residual()
            cell = coarse[:, a] * table.shape[1] + coarse[:, b]
            g, h = np.bincount(cell, r, table.size).reshape(table.shape), np.bincount(cell, w, table.size).reshape(table.shape)
            # a tree of depth two: rows are cut into leaves first, columns within each
            step = np.zeros_like(table)
            rows = _tree(g.sum(1), h.sum(1), penalty)
            for value in np.unique(rows):
                leaf = rows == value
                step[leaf] = _tree(g[leaf].sum(0), h[leaf].sum(0), penalty)
            step = rate * np.clip(step, -3, 3)
            table += step
            total += step[coarse[:, a], coarse[:, b]]
    return model


_X = "id long, y int, x array<double>"


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["id", "y", "x"])


def sampled_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` non-null labels, those with the smallest hash of the id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows)


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, text_key, y, text of at most ``max_rows`` different labelled texts; rows that repeat an id don't go beyond that bound."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    some = sampled_labels(labels, label, max_rows)
    keys = rows.select("doc_id", "text_key").join(F.broadcast(some), "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "text_key", "y").limit(max_rows)
    return rows.join(F.broadcast(keys), ["doc_id", "text_key"]).groupBy("doc_id", "text_key", "y").agg(F.first("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Gam:
    """Fit on a bounded sample of labelled documents; ``labels``: doc_id, quality (already without held-out rows).

    Features are computed by executors; the driver gets ``max_rows`` rows of numbers at most.
    """
    rows = sampled_texts(docs, labels, "quality", max_rows)
    got = rows.select("doc_id", "y", "text").mapInArrow(_featured, _X).toPandas()
    x, y = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES)), got["y"].to_numpy(float)
    order = np.lexsort([*x.T, y, got["id"].to_numpy(float)])
    return fit(x[order], y[order])


def _scorer(model: Gam, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([features(t.as_py()) for t in batch.column(batch.num_columns - 1)], float)
                score = model.score(x)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    return run


def score_documents(docs: DataFrame, model: Gam, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for every document."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_scorer(model, threshold), "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Gam, threshold: float = 0.5) -> DataFrame:
    """The documents that are likelier good than not, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scorer(model, threshold), f"row {docs.schema.simpleString()}, score double, predicted int")
    return scored.filter("predicted = 1").select("row.*")


def op2_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of the training folds."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.filter(fold_of(F.col("doc_id"), 4) != 2))
    scored = score_documents(docs, model)
    return scored.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
