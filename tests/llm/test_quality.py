"""Quality features on long runs, and held-out accuracy of the registered query."""

import re
import time

import numpy as np

from lodeweave.llm import quality
from tests.llm.test_operators import frame


def test_odd_ends_are_those_of_the_plain_pattern():
    plain = re.compile(r"[^\w\s.,;:!?'\")\]]+(?=\s|$)")
    for t in ("a== b", "=== x==y -- z", "==a", "a|b| |", "##\n", "(x) [y] {z}", "", "…» «é»"):
        assert quality._ODD_END.findall(t) == plain.findall(t)


def test_long_runs_take_linear_time(spark):
    runs = ["=" * 10**6 + "a", " " * 10**6, "x" * 10**6, "\n" * 10**6, "=a" * 500_000, "!" * 10**6]
    began = time.time()
    rows = [quality.features(t) for t in runs]
    assert time.time() - began < 30 and np.isfinite(rows).all()
    model = quality.fit(np.random.default_rng(0).random((50, len(quality.FEATURES))), np.arange(50) % 2)
    got = quality.score_documents(frame(spark, [(i, t, "en", "a") for i, t in enumerate(runs)] * 2), model).toPandas()
    assert len(got) == 12 and got.groupby("doc_id").score.nunique().eq(1).all()


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = quality.op2_gam_quality(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out & got.quality.notna()]
    assert len(held) > 30 and (held.predicted == held.quality).mean() > 0.9
