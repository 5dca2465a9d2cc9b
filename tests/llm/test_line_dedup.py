"""The registered line query against comparing all pairs of lines, and its parts."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodeweave.llm import line_dedup, linejoin
from lodeweave.llm.tokensets import Lines, Rarity, batches
from tests.llm.test_operators import LOWER, WORD


def rows():
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in "abcdefghij" for b in range(30)]
    line = lambda n: [rng.choice(vocab) for _ in range(n)]
    out, made = [], []
    for i in range(160):
        text = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if made and kind < 0.25:
                words = rng.choice(made)
            elif made and kind < 0.6:
                words = list(rng.choice(made))
                for _ in range(rng.randint(1, 1 + len(words) // 9)):
                    words[rng.randrange(len(words))] = rng.choice(vocab)
            else:
                words = line(rng.choice([1, 2, 3, 4, 5, 9, 15, 16, 17, 40, 63, 64, 66, 130, 300]))
            made.append(words)
            text.append(" ".join(words))
        out.append((rng.randrange(10**6), "\n".join(text)))
    ten = lambda *odd: " ".join(f"x{k}" if k in odd else f"w{k}" for k in range(10))
    out += [(2_000_000, ten()), (2_000_001, ten(0, 1)), (2_000_002, ten(0))]  # a, c, b: a ~ b ~ c, but not a ~ c
    out += [(5, "same row\nwith two lines of words"), (5, "same row\nwith two lines of words")]
    out += [(6, f"{ten(3)}\nonly here q r s t"), (6, "only there u v w x y")]
    out += [(None, f"{ten(0)}\n\nno id one two three"), (None, "no id one two three four"), (None, None), (7, None), (8, ""), (9, " \n\t\n"), (10, "\n" * 50)]
    return out


def sets_of(text):
    return [frozenset(WORD.findall(x.translate(LOWER))) for x in (text or "").split("\n")]


def expected(found, tie):
    """Removed line numbers by row, by comparing all pairs in order of (id, hash of the row, row number, line)."""
    order = sorted((i is not None, i or 0, tie[u], u, k, s) for u, (i, t) in enumerate(found) for k, s in enumerate(sets_of(t)) if s)
    out = {}
    for a, (*_, u, k, s) in enumerate(order):
        if any(100 * len(s & o) >= 80 * len(s | o) for *_, o in order[:a]):
            out.setdefault(u, []).append(k)
    return out


def test_registered_query(spark, tmp_path):
    found = rows()
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in found], pa.int64()), "text": [t for _, t in found], "uid": [1] * len(found)}), tmp_path / "documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    hashes = {(r["doc_id"], r["text"]): r["h"] for r in table.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).collect()}
    got = sorted((tuple(r) for r in line_dedup.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_removed", "removed", "left_sha256").collect()), key=repr)
    gone = expected(found, [hashes[r] for r in found])
    want = []
    for u, (i, t) in enumerate(found):
        lines, removed = (t or "").split("\n"), sorted(gone.get(u, []))
        left = "\n".join(x for k, x in enumerate(lines) if k not in removed)
        want.append((i, len(lines), len(removed), removed, hashlib.sha256(left.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert sum(map(len, gone.values())) > 100


@pytest.mark.parametrize("num, den", [(50, 100), (80, 100), (95, 100)])
def test_similar_lines_share_a_key(num, den):
    rng = random.Random(num)
    lines, sizes = [], [1, 2, 3, 4, 5, 7, 12, 15, 16, 18, 40, 62, 64, 70, 200, 255, 260, 1000]
    for _ in range(150):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice(sizes))]
        lines.append(" ".join(base))
        for _ in range(2):
            other = list(base)
            for _ in range(rng.randint(1, max(1, len(base) * (den - num) // den))):
                if rng.random() < 0.3 and len(other) > 1:
                    other.pop(rng.randrange(len(other)))
                else:
                    other.insert(rng.randrange(len(other)), f"v{rng.randrange(5000)}")
            lines.append(" ".join(other))
    ranks = np.random.default_rng(1).integers(0, 64, 1 << 12).astype(np.uint8)
    (sets,) = batches(pa.array(lines), Lines(), Rarity(ranks, ranks))
    item, token = sets.order
    who, key, short = linejoin.pair_keys(item, token, sets.count, num, den)
    keys, shorts, words = [set() for _ in lines], [set() for _ in lines], [set(x.split()) for x in lines]
    for w, k, s in zip(who.tolist(), key.tolist(), short.tolist()):
        keys[w].add(k)
        if s:
            shorts[w].add(k)
    bits = linejoin.set_parities(sets).T.view(np.uint64)
    near = 0
    for i in range(len(lines)):
        for j in range(i - i % 3, i):
            if words[i] != words[j] and den * len(words[i] & words[j]) >= num * len(words[i] | words[j]):
                near += 1
                assert keys[i] & shorts[j] or shorts[i] & keys[j]
                assert len(linejoin.near_groups(np.zeros(2), np.arange(2), sets.count[[i, j]], bits[[i, j]], num, den)[0]) == 2
    assert near > 40


def test_other_thresholds(spark):
    from tests.llm.test_operators import classes, frame

    texts = ["a b c", "a b d", "a b", "b a", "x", "x y", "q r s t\nq r s u", None]
    d = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    sets = {(i, k): s for i, t in enumerate(texts) for k, s in enumerate(sets_of(t)) if s}
    got = {(r["doc_id"], r["line"]): (r["class_doc"], r["class_line"]) for r in line_dedup.line_classes(d, 50, 100).collect()}
    assert got == classes(sets, 50, 100)


def test_meetings_keep_only_fitting_pairs():
    rng = np.random.default_rng(2)
    n = 5000
    key, name = rng.integers(0, 1 << 11, n).astype(np.uint64) << np.uint64(20), rng.integers(0, 60, n).astype(np.uint64) << np.uint64(40)
    size, short = linejoin.size_steps(10 + (name >> np.uint64(40)).astype(np.int64) * 7), rng.random(n) < 0.3
    got = linejoin.meetings([linejoin.packed(linejoin.key_columns(*(x[a : a + 700] for x in (key, name, short, size))), linejoin.KEY) for a in range(0, n, 700)])
    got = set(zip(*(x.tolist() for x in got)))
    held = {}
    for k, m, s in zip(key.tolist(), name.tolist(), short.tolist()):
        held.setdefault(k, {}).setdefault(m, []).append(s)
    real = lambda m: 10 + (m >> 40) * 7
    kept = wanted = 0
    for k, members in held.items():
        for a in members:
            fits = any(b != a and 100 * min(real(a), real(b)) >= 80 * max(real(a), real(b)) and any(members[a if real(a) <= real(b) else b]) for b in members)
            wanted += fits
            kept += (k, a) in got
            assert not fits or (k, a) in got
    assert len(got) == kept and wanted <= kept < 1.5 * wanted


def test_described_and_near_rows():
    """Names that stand for two sets give both, and rows of a bucket are compared within their key only."""
    rng = np.random.default_rng(3)
    high = rng.integers(-(1 << 62), 1 << 62, 40)
    high[20:22] = high[:2] ^ (1 << 60)  # the same name
    sets = [high, rng.integers(5, 9, 40), *(rng.integers(-(1 << 62), 1 << 62, 40) for _ in range(2))]
    sets[2][30:], sets[3][30:], sets[1][30:] = sets[2][5:15], sets[3][5:15], sets[1][5:15]
    at, who = np.repeat(np.arange(60), 5).astype(np.uint64), rng.integers(0, 40, 300)
    name = high[who].view(np.uint64) & np.uint64((1 << linejoin.NAME_BITS) - 1)
    met = linejoin.packed([at, name & np.uint64((1 << 32) - 1), name >> np.uint64(32)], linejoin.MET)
    got = linejoin.described([met], [linejoin.packed([c[:25] for c in sets], linejoin.SET), linejoin.packed([c[10:] for c in sets], linejoin.SET)])
    twins = {0: [0, 20], 1: [1, 21], 20: [0, 20], 21: [1, 21]}
    assert sorted(zip(*(c.tolist() for c in got))) == sorted((a, *(c[j].item() for c in sets)) for a, i in zip(at.tolist(), who.tolist()) for j in twins.get(i, [i]))
    pivot, num, n = linejoin.near_rows([linejoin.packed(got, linejoin.NEAR)], 80, 100)
    pairs = {(p, x) for p, x in zip(pivot.tolist(), num.tolist()) if p != x}
    members = {}
    for a, h in zip(got[0].tolist(), got[1].tolist()):
        members.setdefault(a, set()).add(h)
    want = {(min(high[i], high[i - 25]).item(), max(high[i], high[i - 25]).item()) for i in range(30, 40) if any({high[i], high[i - 25]} <= m for m in members.values())}
    assert pairs == want and want
    whole = linejoin.near_rows([linejoin.packed(got, linejoin.NEAR)], 80, 100, large=1)
    assert {(p, x) for p, x in zip(whole[0].tolist(), whole[1].tolist())} == {(min(m), x) for m in members.values() for x in m if len(m) > 1 or False}


def test_very_long_lines_and_texts(spark):
    from tests.llm.test_operators import frame

    long = " ".join(f"w{k}" for k in range(200_000))
    d = frame(spark, [(1, long, "en", "a"), (2, long + " more", "en", "a"), (3, "x" * 3_000_000, "en", "a"), (4, " " * 1_000_000, "en", "a"), (5, "=" * 1_000_000, "en", "a"), (6, "a b c d\n" * 100_000, "en", "a")])
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(d).collect()}
    assert got == {2: [0], 6: list(range(1, 100_000))}
