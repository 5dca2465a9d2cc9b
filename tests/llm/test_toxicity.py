"""Held-out accuracy of the toxicity query, its label model against brute-force likelihoods, and hard inputs."""

import random

import numpy as np

from lodeweave.llm import toxicity
from tests.llm.test_operators import frame


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    got = toxicity.op4_weak_toxicity(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out & got.toxic.notna()]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    # a quarter of the labels say toxic of texts without a bad word: noise that no text-only score can follow
    assert len(toxic) > 100 and toxic.predicted.mean() > 0.5 and clean.predicted.mean() < 0.005


def test_posterior_is_that_of_the_weighted_likelihoods():
    rng = np.random.default_rng(5)
    votes = (rng.random((40, 6)) < 0.3).astype(float)
    model = toxicity.LabelModel(rng.uniform(0.05, 0.95, (2, 6)), rng.uniform(0.3, 1, 6), 0.2)
    for v, p in zip(votes, model.posterior(votes)):
        odds = 0.2 / 0.8
        for k in range(6):
            one, zero = (model.rates[c][k] if v[k] else 1 - model.rates[c][k] for c in (1, 0))
            odds *= (one / zero) ** model.discount[k]
        assert abs(p - odds / (1 + odds)) < 1e-9


def test_mined_counts_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gammaray", "delta", "evilword" if i % 3 == 0 else "fine"]) for _ in range(12)), i % 3 == 0) for i in range(300)]
    sample = spark.createDataFrame([(int(y), t) for _, t, y in rows], "y int, text string").repartition(4)
    hits = {}
    for _, t, y in rows:
        for term in toxicity.terms(t):
            a, b = hits.get(term, (0, 0))
            hits[term] = (a + y, b + (not y))
    lexicon, n = toxicity.mined(sample)
    assert n == 100 and lexicon == toxicity.mine({t: h for t, h in hits.items() if h[0] >= max(5, 0.1 * max(a for a, _ in hits.values()))}, 100, 200)
    assert lexicon[0] == "evilword"


def test_long_texts_and_repeated_rows(spark):
    rows = [(i, "clean words here " * 5 + ("vileword nastyish" if i % 4 == 0 else str(i)), "en", "a") for i in range(200)]
    rows = [(i, f"{t} {i // 4}", lang, s) for i, t, lang, s in rows]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)] * 2, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, rows * 2), labels)
    long = [(1, "=" * 10**6, "en", "a"), (2, "A" * 10**6 + "a", "en", "a"), (3, " " * 10**6, "en", "a"), (4, "x y " * 250_000 + "vileword nastyish", "en", "a"), (4, "x y " * 250_000 + "vileword nastyish", "en", "a"), (5, None, "en", "a")]
    got = toxicity.score_documents(frame(spark, long), model).toPandas()
    assert len(got) == 6 and got.groupby("doc_id").score.nunique().eq(1).all()
    assert got[got.doc_id == 4].predicted.tolist() == [1, 1] and got[got.doc_id.isin([2, 3, 5])].predicted.sum() == 0
    assert toxicity.score_documents(frame(spark, []), model).count() == 0
