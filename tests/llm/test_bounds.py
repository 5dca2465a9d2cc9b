"""Bounds on what exact dedup and language identification hold, and their hard inputs."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from lodeweave.llm import cuckoo, mixing, ppm
from tests.llm.test_operators import WORD, frame


def test_local_index_is_bounded():
    rng = random.Random(1)
    digests = [hashlib.sha256(str(rng.randrange(3000)).encode()).digest() for _ in range(20_000)]
    cols = lambda a: [pa.array(digests[a : a + 1000], pa.binary()), *(pa.array(range(a, a + 1000), pa.int64()) for _ in range(2)), *(pa.array([1] * 1000, pa.int64()) for _ in range(2))]
    batches = [pa.RecordBatch.from_arrays(cols(a), schema=cuckoo._ARROW) for a in range(0, 20_000, 1000)]
    first = list(cuckoo._folder(500)(iter(batches)))
    assert max(b.num_rows for b in first) <= 500
    last = list(cuckoo._folder()(iter(first)))
    got = {d: (k, n) for b in last for d, k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist())}
    want = {}
    for i, d in enumerate(digests):
        want[d] = (i, want.get(d, (0, 0))[1] + 1)
    assert got == want


def test_millions_of_digests_in_bounded_memory():
    def batches():
        for a in range(0, 600_000, 10_000):
            ids = range(a, a + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array([i.to_bytes(8, "little") * 4 for i in ids], pa.binary()), *(pa.array(ids, pa.int64()) for _ in range(2)), *(pa.array([1] * 10_000, pa.int64()) for _ in range(2))], schema=cuckoo._ARROW)

    tracemalloc.start()
    n = sum(b.num_rows for b in cuckoo._folder(50_000)(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 600_000 and peak < 60 << 20


def test_chunks_of_a_text_are_those_of_the_whole(monkeypatch):
    text = bytes(random.Random(2).randrange(97, 105) for _ in range(5000))
    tree = ppm.fit([text[:3000], b"abc"])
    whole = ppm.code_lengths([text, b"", text[:7]], [tree])
    monkeypatch.setattr(ppm, "CHUNK", 64)
    assert np.allclose(whole, ppm.code_lengths(iter([text, b"", text[:7]]), [tree], 3))


def test_a_long_text_is_scored_in_bounded_memory():
    tree = ppm.fit([b"some text to learn from, and some more of it " * 20])
    text = b"some text that is long " * 2_200_000  # 50 MB
    tracemalloc.start()
    bits = ppm.code_lengths([text], [tree])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert bits[0, 0] > 0 and peak < 200 << 20


def test_languages_of_long_and_repeated_rows(spark):
    rng = random.Random(9)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(40))
    rows = [(i, make(("abcd", "wxyz")[i % 2]), ("aa", "bb")[i % 2], "s") for i in range(40)]
    models = ppm.train(frame(spark, rows * 3))
    once = ppm.train(frame(spark, rows))
    assert all((a == b).all() for lang in models for a, b in zip(models[lang].costs, once[lang].costs))
    long = [(1, "abcd" * 300_000, None, None), (2, "1 " * 500_000, None, None), (2, "1 " * 500_000, None, None), (3, " " * 10**6, None, None), (4, "=" * 10**6 + "wxyz", None, None)]
    got = [(r["doc_id"], r["lang_pred"]) for r in ppm.identify(frame(spark, long), models).collect()]
    assert sorted(got) == [(1, "aa"), (2, "und"), (2, "und"), (3, "und"), (4, "bb")]
    few = ppm.train(frame(spark, rows), max_rows=5, max_bytes=100)
    assert sorted(few) == ["aa", "bb"]


def test_copies_are_those_of_one_pass_over_each_source(spark):
    """Systematic sampling by definition: a row is taken once for each whole number its interval of summed-up copies crosses."""
    rng = random.Random(6)
    rows = [(rng.choice([i, 7, None]), " ".join(["w"] * rng.randint(0, 200)) + f" {i}", "en", rng.choice("aaaabbc") if i % 9 else None) for i in range(600)]
    plan = mixing.plan_mix(frame(spark, rows).repartition(3), shards=5).collect()
    size_of = lambda t: len(WORD.findall(t))
    digest = lambda s, n: int(hashlib.md5(s.encode()).hexdigest()[:n], 16)
    want = []
    target = {r["source"]: r["target"] for r in plan}
    for s in ("a", "b", "c", None):
        def place(r):
            x = size_of(r[1]) + 1
            b = x.bit_length()
            tie = digest(f"{'' if r[0] is None else r[0]} {r[1]}", 15)
            return (b * 8 + ((x >> max(b - 4, 0)) & 7), tie % 5, x, tie)

        mine = sorted((r for r in rows if r[3] == s), key=place)
        total = sum(size_of(r[1]) for r in mine)
        start, rate = digest(f"17 {'-' if s is None else '=' + s}", 4) / 65536, target[s] / total
        for k, r in enumerate(mine):
            want.append((r[0], size_of(r[1]), int(start + rate * (k + 1)) - int(start + rate * k)))
    assert sorted(((r["doc_id"], r["size"], r["copies"]) for r in plan), key=repr) == sorted(want, key=repr)


def test_sizes_of_long_texts(spark):
    rows = [(1, "a " * 500_000, "en", "a"), (2, " " * 10**6, "en", "a"), (3, "x" * 10**6, "en", "a"), (3, "x" * 10**6, "en", "a"), (None, None, None, None)]
    got = sorted((r["doc_id"] or 0, r["size"]) for r in mixing.plan_mix(frame(spark, rows)).collect())
    assert got == [(0, 0), (1, 500_000), (2, 0), (3, 1), (3, 1)]
