"""Toxicity by weak supervision.

Many voters look at a text: words and word beginnings that a lexicon holds, and patterns of form.  A generative label model
estimates each voter's hit rates in toxic and clean texts by expectation-maximisation, and the correlations between
voters given the class; a voter that says what others said counts for less.  Its posterior labels train a linear classifier over the
same evidence, and the classifier scores every whole text.

The lexicon is mined from labelled rows of the training folds.  Mining, label model and classifier see at most ``max_rows``
labelled documents (smallest hash of the id; a documented bound); executors count terms and take votes, so no text reaches the driver.  Labels choose the
lexicon and where the label model starts, and rows whose label it doubts count less for its correlations; its hit rates and posteriors are its own.  Scoring covers all rows in one pass without a shuffle.

Defined results: null and empty texts are scored like a text without evidence; texts of any length are scored whole; null labels train nothing; of
contradicting labels of equal texts the toxic one counts; without toxic training rows every score is 0; repeated rows train once and are scored each and
alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, fold_of, materialize, small_batches
from lodeweave.llm.quality import sampled_texts

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that the lexicon may hold (for inflected languages).
STEMS = (4, 5, 6)
#: Voters of form: a pattern each.
PATTERNS = (r"!{2,}", r"\b[A-Z]{4,}\b", r"[$%&#*]{2,}", r"\?{2,}", r"\b(?:you|du|tu|vous|usted)\b", r"(.)\1{3,}")
_PATTERNS = [re.compile(p) for p in PATTERNS]


def terms(text: str | None) -> set[str]:
    """Distinct lower-cased words and, marked by '*', their beginnings."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def mine(hits: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, most: int = 150, least_ratio: float = 50.0) -> list[str]:
    """Terms that are much more frequent in toxic than in clean texts, the surest first; ``hits``: toxic and clean texts by term.

    Whole words win over their beginnings where both say the same.
    """
    found = []
    for t, (toxic, clean) in hits.items():
        rate, base = toxic / max(1, n_toxic), (clean + 0.5) / max(1, n_clean)
        if rate / base >= least_ratio:
            found.append((rate * math.log(rate / base) * (1 + 0.01 * len(t) + 0.1 * (t[-1] != "*")), t))
    found.sort(key=lambda x: (-x[0], x[1]))
    out: list[str] = []
    for _, t in found:
        # what a chosen term already covers, or is covered by, says nothing new
        root = t.rstrip("*")
        if not any((u[-1] == "*" and root.startswith(u[:-1])) or (t[-1] == "*" and u.startswith(root)) for u in out):
            out.append(t)
        if len(out) == most:
            break
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (y, text) to term, toxic and clean texts that have it, summed up within the task some texts at a time."""
    held: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([held[y][t] for t in names], pa.int64()) for y in (1, 0))], names=["term", "toxic", "clean"])
        held[0].clear(), held[1].clear()
        return out

    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held[int(y == 1)].update(terms(text.as_py()))
            if len(held[0]) + len(held[1]) > 500_000:
                yield flush()
    yield flush()


def mined(sample: DataFrame, least_share: float = 0.03) -> tuple[list[str], int]:
    """The lexicon of a sample (y, text) and the number of its toxic texts.

    A term needs ``least_share`` of the toxic texts (and five) and a fair part of the best term's share, so
    that words of a few copied texts don't get in; that many terms of the toxic texts' length / ``least_share`` reach the driver at most.
    """
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    counts = materialize(sample.select("y", "text").mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic > 0"), "terms")
    best = counts.agg(F.max("toxic")).first()[0] or 0
    able = counts.filter(F.col("toxic") >= max(5, least_share * n.get(1, 0), 0.1 * best)).collect()
    return mine({r["term"]: (r["toxic"], r["clean"]) for r in able}, n.get(1, 0), n.get(0, 0)), n.get(1, 0)


class Voters:
    """Evidence of a text: one row of hits (0/1) over lexicon entries, lexicon counts and patterns."""

    def __init__(self, lexicon: list[str]) -> None:
        self.words = {t: i for i, t in enumerate(lexicon) if not t.endswith("*")}
        self.stems = {t[:-1]: i for i, t in enumerate(lexicon) if t.endswith("*")}
        self.size = len(lexicon)

    @property
    def width(self) -> int:
        return self.size + 3 + len(PATTERNS)

    def row(self, text: str | None) -> np.ndarray:
        """Hits by lexicon entry; at least one, two, four hits in all; patterns."""
        out = np.zeros(self.width, np.float32)
        text = text or ""
        total = 0
        for w, n in Counter(_WORD.findall(text.lower())).items():
            if (i := self.words.get(w)) is not None:
                out[i] = 1
                total += n
            for k in STEMS:
                if len(w) > k and (i := self.stems.get(w[:k])) is not None:
                    out[i] = 1
                    total += n
        out[self.size : self.size + 3] = [total >= 1, total >= 2, total >= 4]
        for i, p in enumerate(_PATTERNS):
            out[self.size + 3 + i] = p.search(text) is not None
        return out


@dataclass
class LabelModel:
    """Hit rates by class, discount by voter for what correlated voters said too, and the prior of the toxic class."""

    rates: np.ndarray
    discount: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on, off = (np.log(self.rates[1] / self.rates[0]), np.log((1 - self.rates[1]) / (1 - self.rates[0])))
        odds = votes @ (self.discount * (on - off)) + (self.discount * off).sum() + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _correlations(votes: np.ndarray, p: np.ndarray, weight: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Absolute correlations of what is left of the votes when the rates of the class (toxic with probability ``p``) are taken off."""
    total = max(1e-9, float(weight.sum()))
    rest = votes - (p[:, None] * rates[1] + (1 - p)[:, None] * rates[0])
    rest = (rest - weight @ rest / total) * np.sqrt(weight)[:, None]
    scale = np.sqrt((rest**2).sum(0) / total) + 0.02  # of a vote that hardly varies within a class nothing is known
    return np.abs((rest.T @ rest) / total / scale[:, None] / scale[None, :])


def fit_label_model(votes: np.ndarray, seen: np.ndarray, steps: int = 15, strength: float = 20.0) -> LabelModel:
    """Expectation-maximisation from a start at ``seen`` (0/1 where a label is known, nan elsewhere).

    Known labels set the voters' prior rates (``strength`` pseudo-rows), and a row counts for the correlations as far as the model agrees with its label;
    hit rates, correlations and the posterior of every row are the model's own.
    """
    known = ~np.isnan(seen)
    y = np.where(known, seen, 0.0)
    toxic = y[known].mean() if known.any() else 0.05
    prior_rates = np.stack([(votes[known & (y == c)].sum(0) + 0.5) / ((known & (y == c)).sum() + 1) for c in (0, 1)])
    model = LabelModel(prior_rates.clip(1e-3, 1 - 1e-3), np.ones(votes.shape[1]), float(np.clip(toxic, 1e-3, 0.5)))
    for _ in range(steps):
        # correlations given the class, of rows that the model is sure of: that agree with their label, or are clearly one or the other
        p = model.posterior(votes)
        sure = np.where(known, np.where(y == 1, p, 1 - p), np.maximum(p, 1 - p))
        corr = _correlations(votes, p, sure, model.rates)
        np.fill_diagonal(corr, 0)
        model.discount = 1 / (1 + np.where(corr > 0.2, corr, 0).sum(1))
        p = model.posterior(votes)
        mass = np.stack([1 - p, p])
        model.rates = ((mass @ votes + strength * prior_rates) / (mass.sum(1)[:, None] + strength)).clip(1e-4, 1 - 1e-4)
        model.prior = float(np.clip(p.mean(), 1e-3, 0.5))
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, steps: int = 25, penalty: float = 0.1) -> np.ndarray:
    """Logistic regression on soft labels (last value: intercept) by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    share = float(np.clip(target.mean(), 1e-3, 0.999))
    w[-1] = math.log(share / (1 - share))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-5:
            break
    return w


@dataclass
class Model:
    lexicon: list[str]
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000) -> Model | None:
    """Lexicon, label model and classifier from the training folds; ``docs`` and ``labels`` without held-out rows.

    The sample holds at most ``max_rows`` labelled documents, equal texts once; the driver gets their votes.
    """
    some = sampled_texts(docs, labels, "toxic", max_rows)
    sample = materialize(some.groupBy("text_key", "text").agg(F.max("y").alias("y")), "toxic-sample")
    lexicon, n_toxic = mined(sample)
    if not n_toxic:
        return None

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([voters.row(t.as_py()).tolist() for t in batch.column(2)], pa.list_(pa.float32()))], names=["text_key", "y", "votes"])

    got = sample.select("text_key", "y", "text").mapInArrow(vote, "text_key long, y int, votes array<float>").toPandas().sort_values("text_key")
    votes = np.array(got["votes"].tolist(), np.float32)
    label_model = fit_label_model(votes, got["y"].to_numpy(float))
    return Model(lexicon, fit_linear(votes, label_model.posterior(votes)))


def _scorer(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.lexicon)
        for batch in batches:
            if batch.num_rows:
                score = model.scores(np.stack([voters.row(t.as_py()) for t in batch.column(1)]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for every document."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return slim.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return slim.mapInArrow(_scorer(model, threshold), "doc_id long, score double, predicted int")


def op4_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the classifier of the training folds."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    mine_ = fold_of(F.col("doc_id"), 3) != 1
    scored = score_documents(docs, train(docs.filter(mine_), labels.filter(mine_)))
    return scored.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
