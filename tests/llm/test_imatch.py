"""Fingerprints by definition, and the next document across ranges with outliers, hot ids and missing ids."""

import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lodeweave.llm import imatch
from tests.llm.test_operators import frame

MASK = (1 << 64) - 1


def term_hash(w):
    return xxhash.xxh64_intdigest(w.encode(), 42)


def terms(text):
    return {w for w in re.split(r"[\W_]+", (text or "").lower()) if w}


@pytest.mark.parametrize("least, most", [(0.0, 0.5), (0.1, 0.3)])
def test_fingerprints_by_definition(spark, least, most):
    """Two texts agree in a subset just when they have the same terms of the band in it."""
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(120)]
    texts = [" ".join(rng.choice(vocab[: rng.choice([20, 120])]) for _ in range(rng.randint(0, 60))) for _ in range(80)] + ["", None, "one-off thing", "W1 w1 W1"]
    got = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), least, most).collect()}
    df = Counter(w for t in texts for w in terms(t))
    band = {w for w, n in df.items() if max(2, least * len(texts)) <= n <= max(2, most * len(texts))}
    found = {r["t"] & MASK for r in imatch.band_terms(spark.createDataFrame([(t or "",) for t in texts], "text string"), least, most).collect()}
    assert found == {term_hash(w) for w in band}
    bits = set()
    for h in found:
        bits |= {h & ((1 << imatch.CLASS_BITS) - 1), h >> (64 - imatch.CLASS_BITS)}

    def subsets(text):
        held = [h for h in map(term_hash, terms(text)) if h & ((1 << imatch.CLASS_BITS) - 1) in bits and h >> (64 - imatch.CLASS_BITS) in bits]
        out, shift = [], imatch.CLASS_BITS
        for width, n in imatch.LEVELS:
            out += [frozenset(h for h in held if (h >> shift) & ((1 << width) - 1) == s) for s in range(n)]
            shift += width
        return out

    wanted = [subsets(t) for t in texts]
    for i in range(len(texts)):
        parts = got[i].split(".")
        if not any(wanted[i]):
            assert got[i].startswith("~") and all((got[i] == got[j]) == (terms(texts[i]) == terms(texts[j])) for j in range(len(texts)) if not any(wanted[j]))
            continue
        assert [p != "-" for p in parts] == [bool(s) for s in wanted[i]]
        for j in range(i):
            if any(wanted[j]):
                other = got[j].split(".")
                assert [a == b for a, b in zip(parts, other)] == [a == b for a, b in zip(wanted[i], wanted[j])]


def test_ranges_with_outliers_and_hot_ids(spark):
    rows = [(i, f"t{i}", "en", "a") for i in range(400)] + [(1 << 60, "far", "en", "a"), (-(1 << 60), "near", "en", "a")]
    rows += [(150, f"again {i}", "en", "a") for i in range(200)] + [(None, f"none {i}", "en", "a") for i in range(300)] + [(None, "none 1", "en", "a")] * 5
    d, w = imatch.with_successor(frame(spark, rows).repartition(4), rows_per_range=20)
    sizes = [r["count"] for r in d.groupBy("range").count().collect()]
    assert max(sizes) < 80 and len(sizes) > 20
    got = sorted((tuple(r) for r in d.withColumn("after", F.lead("text").over(w)).filter("not spare").select("doc_id", "text", "after").collect()), key=repr)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (xxhash.xxh64_intdigest(r[1].encode(), 42) ^ (1 << 63))))
    assert got == sorted(((a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])), key=repr)


def test_cells_are_counts_of_bounds(spark):
    rng = random.Random(3)
    for n in (0, 1, 5, 127, 128, 129, 700):
        bounds = sorted(rng.sample(range(-2000, 2000), n))
        values = rng.sample(range(-2100, 2100), 60) + bounds[:20]
        got = spark.createDataFrame([(v,) for v in values], "v long").select("v", imatch._cell(F.col("v"), bounds).alias("c")).collect()
        assert all(r["c"] == sum(b < r["v"] for b in bounds) for r in got)


def test_long_texts(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(["=" * 10**6, " " * 10**6, "x" * 10**6, "ab " * 300_000, "ab " * 300_000])]
    got = imatch.fingerprint_edits(frame(spark, rows)).toPandas().set_index("doc_id")
    assert len(got) == 5 and got.loc[3, "fingerprint"] == got.loc[4, "fingerprint"] and got.near_edited.between(0, 1).all()
