"""Packing against a sequential deficit round-robin, and its hard inputs."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest

from lodeweave.llm import packing
from tests.llm.test_operators import frame


def served(totals, q, window):
    """(queue, token) in the order a sequential deficit round-robin serves them."""
    unit, deficit, sent, out = packing.units(q, window), [0] * len(q), [0] * len(q), []
    while len(out) < sum(totals):
        for s, n in enumerate(totals):
            deficit[s] += int(q[s])
            may = (deficit[s] >> packing.BITS) >> int(unit[s]) << int(unit[s])
            deficit[s] -= may << packing.BITS
            for k in range(sent[s], min(n, sent[s] + may)):
                out.append((s, k))
            sent[s] = min(n, sent[s] + may)
    return out


@pytest.mark.parametrize("window, weights", [(64, None), (64, [1, 5, 1, 0.2]), (128, [1, 0, 3, 0.01]), (32, [0, 0, 0, 1])])
def test_places_are_those_of_a_sequential_round_robin(window, weights):
    rng = random.Random(window)
    totals = np.array([rng.randint(200, 900), rng.randint(20, 60), rng.randint(100, 400), rng.randint(1, 9)])
    q = packing.quanta(totals, None if weights is None else np.array(weights), window)
    assert int(q.sum()) == window << packing.BITS
    q = np.maximum(q, 200)  # a bounded number of rounds for the loop
    expected = {key: pos for pos, key in enumerate(served(totals.tolist(), q, window))}
    for s, n in enumerate(totals.tolist()):
        at = 0
        while at < n:
            to = min(n, at + rng.randint(1, 80))
            lo, length, pos = packing.place(s, at, to, totals, q, window)
            assert lo[0] == at and (lo + length).tolist() == [*lo[1:].tolist(), to]
            for x, m, p in zip(lo.tolist(), length.tolist(), pos.tolist()):
                assert [expected[(s, x + k)] for k in range(m)] == list(range(p, p + m))
                assert p // window == (p + m - 1) // window
            at = to


def test_a_rare_source_in_a_huge_corpus():
    totals = np.array([20_000, *[10**12] * 9])
    q = packing.quanta(totals)
    tracemalloc.start()
    lo, length, pos = packing.place(0, 0, 20_000, totals, q)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lo) < 700 and int(length.sum()) == 20_000 and (np.diff(pos) > 0).all() and peak < 50 << 20


def test_more_sources_than_queues_keep_their_targets(spark):
    rows = [(i, "word " * 30, "en", f"s{i % 9}") for i in range(900)]
    d = frame(spark, rows).repartition(3)
    wanted = {"s0": 1, "s1": 3, "s2": 1}
    share = {}
    for most in (2, 3, 4096):
        got = packing.pack(d, wanted, window=256, max_queues=most).toPandas().merge(d.select("doc_id", "source").toPandas(), on="doc_id")
        early = got[got.sequence_id < 15]
        share[most] = early.groupby("source").length.sum() / early.length.sum()
        assert got.length.sum() == 900 * 32 and early.groupby("sequence_id").length.sum().tolist() == [256] * 15
    assert abs(share[4096].get("s1", 0) - 0.6) < 0.02 and abs(share[4096].get("s0", 0) - 0.2) < 0.02
    for most in (2, 3):  # s0 and s2 (or all three) share a queue; what has no target waits
        assert share[most].reindex(["s0", "s1", "s2"]).sum() > 0.98
    assert abs(share[3].get("s1", 0) - 0.6) < 0.02
    mixed = packing.pack(d, window=256, max_queues=4).toPandas()
    assert mixed.length.sum() == 900 * 32 and mixed.groupby("doc_id").length.sum().eq(32).all()


def test_long_runs(spark):
    from tokenizers import Tokenizer

    ranks, full = packing.default_vocab()
    encode, whole = packing.Encoder(ranks, full), Tokenizer.from_file(full)
    blank = " " * 5000
    for t in (blank, f"a{blank}b", f"{blank}x\n{blank}", f"a{blank}\t{blank}  {blank}'s b", f"a \x1c{blank}\x1c b", f"{blank}\n7{'=' * 3000} ..."):
        assert encode(t).tolist() == [*whole.encode(t, add_special_tokens=False).ids, packing.END_ID]
    million = [" " * 10**6, "a" + "\n" * 10**6 + "b", "=" * 10**6, "x" * 10**6, " \t" * 5 * 10**6]
    got = packing.pack(frame(spark, [(i, t, "en", "a") for i, t in enumerate(million)])).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(encode(t)) for i, t in enumerate(million)}


def test_registered_query(spark, sf):
    got = packing.op1_mixture_pack(spark, sf).toPandas()
    encode = packing.Encoder(*packing.default_vocab())
    want = {r["doc_id"]: encode(r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(got.doc_id) == set(want) and got.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in want.items()}
    for r in got.itertuples():
        assert r.doc_tokens == len(want[r.doc_id]) and zlib.crc32(want[r.doc_id][r.start : r.start + r.length].astype("<u4").tobytes()) == r.ids_crc32
    sizes = got.groupby("sequence_id").length.sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.tolist()) and (sizes < 2048).sum() <= 11
    assert (got.sort_values(["sequence_id", "offset"]).groupby("sequence_id").offset.first() == 0).all()
