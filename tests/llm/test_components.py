"""Components of links against a union-find, and what is too large for 64-bit sums."""

import random

import pytest
from pyspark.sql import functions as F

from lodeweave.llm import components as c


def expected(links):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(up)}


def shapes():
    rng = random.Random(1)
    yield [(i, i + 1) for i in range(70)]  # a chain
    yield [(0, i) for i in range(1, 200)] + [(500, i) for i in range(100, 300)]  # two hubs that share leaves
    yield [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    yield [(-(1 << 63), 5), (5, (1 << 63) - 1), (7, 7), (9, 8), (8, 9), (9, 8)]
    yield []


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_components(spark, monkeypatch, sent):
    monkeypatch.setattr(c, "MOST_SENT", sent)
    for links in shapes():
        got = c.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len(got) == len({r["id"] for r in got})
        assert {r["id"]: r["component"] for r in got} == expected(links)


def test_twenty_million_links(spark):
    links = spark.range(20_000_000).select((F.col("id") * 2 + 1).alias("a"), (F.col("id") - F.col("id") % 1000).alias("b"))
    n, least, top = c.components(links).agg(F.count(F.lit(1)), F.min("component"), F.countDistinct("component")).first()
    assert n >= 20_000_000 and least == 0 and top > 0


def test_sets_that_share_half_a_name(monkeypatch, spark):
    """Names in full tell sets apart whose first halves are shared; without such sets nothing changes."""
    import numpy as np

    from lodeweave.llm import ngram_join, setjoin, tokensets
    from tests.llm.test_operators import classes, frame, shingles

    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(30)) for _ in range(12)]
    texts += [t + " more" for t in texts[:5]] + texts[:3]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    real = setjoin.SetJoin.__post_init__
    halves = []

    def post(self):
        real(self)
        halves.append(len(self.doubles))

    monkeypatch.setattr(setjoin.SetJoin, "__post_init__", post)
    want = classes({i: shingles(t, 3) for i, t in enumerate(texts)}, 80, 100)
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.near_components(frame(spark, rows), 3, 80).collect()} == want
    assert halves == [0]
    import pyarrow as pa

    (sets,) = tokensets.batches(pa.array(texts), tokensets.Shingles(3))
    high, low = sets.names()
    ids = sets.ids(np.sort(high[:4]))
    assert len(set(ids.tolist())) == len(set(zip(high.tolist(), low.tolist()))) and (ids[4:12] == high[4:12]).all() and (ids[:4] != high[:4]).all()
