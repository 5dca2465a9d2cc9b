"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeweave.llm import cuckoo, imatch, line_dedup, mixing, ngram_join, packing, ppm, quality, toxicity, wordpiece
from lodeweave.llm.common import fold_of
from lodeweave.llm.tokensets import Lines, Shingles, batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, key string, tie int, digest string, set_id int, copies int, rank int, component string"


def frame(spark, rows):
    """Documents with columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "r", 1, "k", 2, "d", 3, 4, 5, "c") for i, t, lang, s in rows], SCHEMA)


def corpus(seed=5, n=120):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = text(60)
    rows = []
    for i in range(n):
        kind = i % 6
        base = rows[rng.randrange(len(rows))][1] if rows and kind in (1, 2) else None
        if kind == 1 and base:
            t = base
        elif kind == 2 and base:
            w = base.split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        elif kind == 3:
            t = text(40) + "\n" + passage + "\n" + text(20)
        else:
            t = "\n".join(text(rng.randint(1, 30)) for _ in range(rng.randint(1, 8)))
        rows.append((i, t, rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "", None])))
    rows += [(n, None, None, None), (n + 1, "", None, "b"), (n + 2, " \n\t", "en", "b"), (n + 3, "one", "en", "a"), (n + 4, "ONE", "en", "a"), (n + 5, "x y " * 30_000, "en", "a"), (n + 6, "ü😀 é ß", "de", "a"), (None, "no id here at all", "en", "a"), (3, rows[3][1], "en", "a"), (3, rows[3][1], "en", "a")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, []).filter("doc_id is not null")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def classes(sets, num, den):
    """Least key of each set's component, by comparing all pairs."""
    up = {k: k for k in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) * den >= num * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {k: top(k) for k in sets}


# 1 packing


@pytest.mark.parametrize("targets", [None, {"a": 1, "b": 5, "": 1}])
def test_packing(docs, rows, targets):
    got = packing.pack(docs, targets, window=64).toPandas()
    encode = packing.Encoder(*packing.default_vocab())
    assert len(encode("a<|endoftext|>b")) == 4
    for (doc, total), part in got[got.doc_id != 3].groupby(["doc_id", "doc_tokens"]):
        ids = encode(next(t for i, t, _, _ in rows if i == doc) or "")
        part = part.sort_values("start")
        assert len(ids) == total and part.start.iloc[0] == 0 and (part.start + part.length).iloc[-1] == total
        assert (part.start + part.length).iloc[:-1].tolist() == part.start.iloc[1:].tolist()
        for r in part.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].astype("<u4").tobytes()) == r.ids_crc32
    assert got[got.doc_id == 3].length.sum() == 3 * len(encode(rows[3][1]))
    sizes = []
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.iloc[0] == 0 and (part.offset + part.length).iloc[:-1].tolist() == part.offset.iloc[1:].tolist()
        sizes.append(int(part.length.sum()))
    assert all(n == 64 or (n & (n - 1)) == 0 for n in sizes) and sum(n < 64 for n in sizes) <= 6
    assert got.sequence_id.nunique() == got.sequence_id.max() + 1


def test_ranks_give_the_ids_of_the_full_definition(rows):
    from tokenizers import Tokenizer

    ranks, full = packing.default_vocab()
    encode, whole = packing.Encoder(ranks, full), Tokenizer.from_file(full)
    texts = [t or "" for _, t, _, _ in rows if len(t or "") < 5000] + ["It's we'll 12345  \n\n\t x", "日本語 ñandú É\u0301 \u00a0x\u2003y", "a<|endoftext|>b", "\x00\x7f…—“q”", "x" * 300]
    for t in texts:
        assert encode(t).tolist() == [*whole.encode(t, add_special_tokens=False).ids, packing.END_ID]


def test_packing_keeps_proportions(spark):
    d = frame(spark, [(i, "word " * 50, "en", "a" if i % 4 else "b") for i in range(200)]).repartition(3)
    got = packing.pack(d, window=128).toPandas().merge(d.select("doc_id", "source").toPandas(), on="doc_id")
    share = got[got.source == "b"].groupby("sequence_id").length.sum().reindex(range(got.sequence_id.max()), fill_value=0) / 128
    assert abs(share - 0.25).max() < 0.03
    wanted = packing.pack(d, {"a": 1, "b": 1}, window=128).toPandas().merge(d.select("doc_id", "source").toPandas(), on="doc_id")
    early = wanted[(wanted.sequence_id < 30) & (wanted.source == "b")].groupby("sequence_id").length.sum() / 128
    assert abs(early - 0.5).max() < 0.03


def test_packing_empty(none):
    assert packing.pack(none).count() == 0


# 2 quality


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_quality_scores(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, int(i % 6 != 3), 0) for i in range(100)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.score_documents(docs, model).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    flat = quality.train(none, labels)
    assert quality.score_documents(docs, flat).agg(F.max("score")).first()[0] == pytest.approx(0.5)
    assert quality.score_documents(none, flat).count() == 0
    assert len(quality.features(None)) == len(quality.FEATURES) and np.isfinite(quality.features("")).all()


# 3 line dedup


def test_line_dedup(docs, rows, none):
    sets = {}
    for i, t, _, _ in rows:
        for k, line in enumerate((t or "").split("\n")):
            w = frozenset(WORD.findall(line.translate(LOWER)))
            if w and i is not None:
                sets[(i, k)] = w
    expected = classes(sets, 80, 100)
    got = {(r.doc_id, r.line): (r.class_doc, r.class_line) for r in line_dedup.line_classes(docs.filter("doc_id is not null")).toPandas().itertuples()}
    assert got == expected and any(k != v for k, v in expected.items())
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in out.filter("doc_id <> 3").toPandas().itertuples() if r.doc_id == r.doc_id}
    for i, t, _, _ in rows:
        if i is not None and i != 3 and t is not None:
            assert text[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in expected or expected[(i, k)] == (i, k))
    assert line_dedup.line_classes(none).count() == 0 and line_dedup.drop_lines(none).count() == 0


def test_lines_go_only_with_an_earlier_match(spark):
    line = lambda *odd: " ".join(f"x{k}" if k in odd else f"w{k}" for k in range(10))
    a, b, c = line(), line(0), line(0, 1)  # a ~ b ~ c, but not a ~ c
    rows = [(1, a, "en", "s"), (2, c, "en", "s"), (3, b, "en", "s")]
    assert {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(frame(spark, rows)).collect()} == {1: a, 2: c, 3: ""}
    rows = [(1, a, "en", "s"), (2, b, "en", "s"), (3, c, "en", "s")]
    assert {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(frame(spark, rows)).collect()} == {1: a, 2: "", 3: ""}
    rows = [(None, a + "\n" + b, "en", "s"), (None, "p\nq r s t u", "en", "s"), (5, c, "en", "s")]  # lines of rows without an id are compared, and lost alone
    assert sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.drop_lines(frame(spark, rows)).collect()) == [(0, "p\nq r s t u"), (0, a), (5, "")]


def test_later_lines_against_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(12)]
    rows = []
    for i in range(150):
        base = [w if rng.random() > 0.06 else f"v{rng.randrange(40)}" for w in base]
        rows.append((rng.randrange(10**6) * 200 + i, " ".join(base), "en", "s"))
    sets = {i: frozenset(t.split(" ")) for i, t, _, _ in rows}
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    expected = {i for i in sets if any(j < i and near(sets[i], sets[j]) for j in sets)}
    got = {r["doc_id"] for r in line_dedup.removed_lines(frame(spark, rows)).collect()}
    assert got == expected
    chained = {r["doc_id"] for r in line_dedup.line_classes(frame(spark, rows)).filter("doc_id <> class_doc").collect()}
    assert expected < chained


# 4 toxicity


def test_toxicity(spark, none):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(vocab) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for bad in rng.sample(["vileword", "nastyish", "grubx" + rng.choice("abcd") * 3], 2):
                w.insert(rng.randrange(40), bad)
        rows.append((i, " ".join(w), "en", "a"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None), (1001, "", "en", "a")]
    d = frame(spark, rows).repartition(3)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    held = fold_of(F.col("doc_id"), 3) == 1
    model = toxicity.train(d.filter(~held), lab.filter(~held))
    got = toxicity.score_documents(d.filter(held), model).toPandas()
    real = got[got.doc_id < 600]
    assert ((real.predicted == 1) == (real.doc_id % 5 == 0)).mean() > 0.97
    assert toxicity.score_documents(d.filter("doc_id >= 1000"), model).agg(F.max("score")).first()[0] < 0.5
    assert toxicity.train(none, lab) is None
    assert toxicity.score_documents(d, None).agg(F.max("score")).first()[0] == 0


def test_label_model_discounts_copies():
    rng = np.random.default_rng(3)
    y = rng.random(2000) < 0.3
    vote = lambda hit, miss: np.where(y, rng.random(2000) < hit, rng.random(2000) < miss).astype(float)
    a = vote(0.8, 0.1)
    votes = np.column_stack([a, a, a, vote(0.8, 0.1), vote(0.7, 0.2), vote(0.7, 0.2)])
    seen = np.where(rng.random(2000) < 0.2, y, np.nan)
    model = toxicity.fit_label_model(votes, seen)
    assert model.discount[:3].max() < 0.6 < model.discount[3:].min()
    assert abs(model.rates[1][3] - 0.8) < 0.1


# 5 fingerprints


def test_imatch(spark, docs, rows, none):
    d = docs.filter("doc_id is not null and doc_id <> 3")
    got = imatch.fingerprint_edits(d, least=0.0, most=0.5).toPandas().set_index("doc_id")
    texts = sorted(((i, t or "") for i, t, _, _ in rows if i is not None and i != 3), reverse=True)
    for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got.loc[i, "edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got.loc[i, "n_chars"] == len(t)
        if edited == t:
            assert got.loc[i, "near_edited"] == 1 and got.loc[i, "fingerprint"] == got.loc[i, "edited_fingerprint"]
    by_text = {}
    for i, t in texts:
        by_text.setdefault(t, set()).add(got.loc[i, "fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert got.near_edited.mean() > got.near_next.mean() + 0.05
    assert imatch.fingerprint_edits(none).count() == 0
    plain = imatch.fingerprints(docs)
    assert plain.columns == [*docs.columns, "fingerprint"] and plain.filter("fingerprint is null").count() == 0
    assert imatch.fingerprint_edits(docs).count() == len(rows)
    alone = imatch.fingerprint_edits(frame(spark, [(1, "just one text", "en", "a")])).first()
    assert alone["near_next"] == 1.0


def test_successors_across_ranges(spark):
    rows = [(i * i * 1000, f"t{i}", "en", "a") for i in range(300)]
    got = {r["doc_id"]: r["after"] for r in (lambda d, w: d.withColumn("after", F.lead("text").over(w)).filter("not spare"))(*imatch.with_successor(frame(spark, rows), rows_per_range=7)).collect()}
    order = sorted(rows, reverse=True)
    assert got == {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1])}


# 6 token counts


def test_automaton_is_greedy():
    rng = random.Random(4)
    for _ in range(60):
        begin = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(8)}
        inside = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(8)}
        automaton = wordpiece.Automaton(sorted(begin), sorted(inside))
        for _ in range(60):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == wordpiece.greedy_count(word, begin, inside)


def test_token_counts(docs, rows, none):
    begin, inside = map(set, wordpiece.vocabulary())
    for r in wordpiece.token_counts(docs).toPandas().itertuples():
        if r.doc_id == r.doc_id and r.doc_id != 3:
            words = WORD.findall(next(t for i, t, _, _ in rows if i == r.doc_id) or "")
            known = Counter(words)
            pieces = {w: wordpiece.greedy_count(w, begin, inside) for w in known}
            assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(n * max(1, pieces[w]) if pieces[w] else 0 for w, n in known.items()), sum(n for w, n in known.items() if pieces[w] < 0))
    assert wordpiece.token_counts(none).count() == 0


# 7 exact dedup


def test_cuckoo_index():
    rng = random.Random(6)
    index, live = cuckoo.CuckooIndex(8), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    twin = keys[0][:10] + bytes(22)
    for step in range(20_000):
        k = rng.choice(keys)
        if k in live and rng.random() < 0.4:
            assert index.delete(k)
            del live[k]
        elif k not in live:
            index.insert(k, step)
            live[k] = step
    assert len(index) == len(live) and index.resizes > 0 and dict(index.items()) == live
    assert all((index.find(k) if k in live else -1) == live.get(k, -1) for k in keys) and all((k in index) == (k in live) for k in keys)
    assert twin not in index and not index.delete(twin)


def test_exact_dedup(docs, rows, none):
    got = cuckoo.mark_duplicates(docs).toPandas()
    groups = {}
    for i, t, _, _ in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows) and int(got.kept.sum()) == len(groups)
    for digest, part in got.groupby("text_sha256"):
        ids = next(v for t, v in groups.items() if hashlib.sha256(t.encode()).hexdigest() == digest)
        assert set(part.group_size) == {len(ids)}
        if None not in ids:
            assert set(part.keep_id) == {max(ids)} and part[part.kept].doc_id.tolist() == [max(ids)]
    kept = cuckoo.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(groups)
    assert cuckoo.exact_dedup(none).count() == 0 and cuckoo.mark_duplicates(none).count() == 0


# 8 n-gram join


@pytest.mark.parametrize("words, num", [(3, 90), (5, 80), (3, 60)])
def test_ngram_join(docs, rows, words, num):
    sets = {i: shingles(t, words) for i, t, _, _ in rows if i is not None}
    expected = classes(sets, num, 100)
    got = ngram_join.near_components(docs, words, num).toPandas()
    assert len(got) == len(rows)
    got = got[got.doc_id.notna()]
    assert {int(r.doc_id): int(r.component_id) for r in got.itertuples()} == expected
    assert all(int(r.n_shingles) == len(sets[int(r.doc_id)]) for r in got.itertuples())


def test_drop_near_duplicates(docs, rows, none):
    sets = {i: shingles(t, 5) for i, t, _, _ in rows if i is not None}
    top = classes(sets, 80, 100)
    got = ngram_join.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    ids = sorted((r["doc_id"] for r in got.collect()), key=lambda x: (x is None, x))
    assert ids == [*sorted({v for k, v in top.items()}), None]
    assert ngram_join.drop_near_duplicates(none).count() == 0 and ngram_join.near_components(none).count() == 0


def test_rows_without_an_id_are_linked(spark):
    text = lambda *odd: " ".join(f"w{k}" if k not in odd else f"x{k}" for k in range(40))
    rows = [(7, text(0, 39), "en", "s"), (None, text(0), "en", "s"), (4, text(), "en", "s"), (None, " ".join(f"y{k}" for k in range(40)), "en", "s"), (None, " ".join(f"y{k}" for k in range(41)), "en", "s")]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_components(frame(spark, rows[:3]), 2, 94).collect()}
    assert got == {7: 4, None: 4, 4: 4}  # 7 and 4 only by way of the row between them
    assert len({r["component"] for r in ngram_join.near_components(frame(spark, rows), 2, 94).collect()}) == 2
    assert ngram_join.drop_near_duplicates(frame(spark, rows), 2, 94).count() == 2


def test_one_document_stays_of_each_component(spark):
    text = lambda name, n=40: " ".join(f"{name}{k}" for k in range(n))
    rows = [
        (None, text("a"), "en", "s"),  # unlike texts without an id, one of them twice
        (None, text("b"), "en", "s"),
        (None, text("c"), "en", "s"),
        (None, text("c"), "en", "t"),
        (1, text("d"), "en", "s"),  # one id, two unlike texts, each with a near copy
        (1, text("e"), "en", "s"),
        (2, text("d") + " more", "en", "s"),
        (3, text("e") + " more", "en", "s"),
        (4, text("f"), "en", "s"),  # the copy without an id goes
        (None, text("f"), "en", "s"),
    ]
    out = [(r["doc_id"], r["text"]) for r in ngram_join.drop_near_duplicates(frame(spark, rows)).collect()]
    expected = [(None, text("a")), (None, text("b")), (None, text("c")), (1, text("d")), (1, text("e")), (4, text("f"))]
    assert sorted(out, key=repr) == sorted(expected, key=repr)


def test_a_large_family_of_near_copies(spark):
    """Chains, a family around one text, and strangers that share a passage: as by comparing all pairs."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w), "en", "a"))
    rows += [(200 + i, " ".join([word() for _ in range(25)] + passage), "en", "a") for i in range(60)]
    chain = [word() for _ in range(100)]
    for i in range(20):
        rows.append((300 + i, " ".join(chain), "en", "a"))
        chain[5 * i % 100] = word()
    sets = {i: shingles(t, 3) for i, t, _, _ in rows}
    got = {r.doc_id: r.component_id for r in ngram_join.near_components(frame(spark, rows).repartition(4), 3, 90).toPandas().itertuples()}
    assert got == classes(sets, 90, 100)


def test_token_sets_of_long_texts(monkeypatch):
    import pyarrow as pa

    from lodeweave.llm import tokensets

    texts = ["A b\tc d  e", None, "", "word " * 500 + "tail\nlast line of it", "ü é ß ä ö\nü é", "x" * 900 + " y z"]
    whole = [s for s in batches(pa.array(texts), Shingles(3))]
    lines = [s for s in batches(pa.array(texts), Lines())]
    monkeypatch.setattr(tokensets, "PIECE", 64)
    cut = [s for s in batches(pa.array(texts), Shingles(3))]
    cut_lines = [s for s in batches(pa.array(texts), Lines())]
    flat = lambda parts: sorted((int(o), int(line), int(c), int(i)) for s in parts for o, line, c, i in zip(s.owner, s.line, s.count, s.ids()))
    assert flat(whole) == flat(cut) and flat(lines) == flat(cut_lines)
    assert [c for _, _, c, _ in flat(whole)] == [len(shingles(t, 3)) for t in texts]


# 9 language


def test_ppm(spark, none):
    rng = random.Random(9)
    alphabet = {"aa": "abcd efg", "bb": "efgh abü"}
    make = lambda lang: " ".join("".join(rng.choice(alphabet[lang]) for _ in range(6)) for _ in range(40))
    rows = [(i, make(("aa", "bb")[i % 2]), ("aa", "bb")[i % 2], "s") for i in range(80)]
    rows += [(100, None, "aa", None), (101, "12 34 !", "aa", "s"), (102, "", "bb", "s"), (103, "abcd", None, "s")]
    d = frame(spark, rows).repartition(3)
    models = ppm.train(d.filter("doc_id < 40 or doc_id >= 100"))
    assert sorted(models) == ["aa", "bb"]
    got = {r["doc_id"]: r for r in ppm.identify(d, models).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows[40:80])
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0) for i in (100, 101, 102)) and got[103]["lang_pred"] == "aa"
    assert ppm.identify(none, models).count() == 0 and ppm.train(none) == {}
    assert {r["lang_pred"] for r in ppm.identify(d, {}).collect()} == {"und"}


def test_code_lengths_are_those_of_the_definition():
    train = b"abracadabra alakazam"
    tree = ppm.fit([train])
    padded = ppm.PAD + train
    seen = {k: Counter() for k in range(ppm.ORDER + 1)}
    for i in range(len(train)):
        for k in range(ppm.ORDER + 1):
            seen[k][padded[i + ppm.ORDER - k : i + ppm.ORDER + 1]] += 1

    def bits(text):
        data, total = ppm.PAD + text, 0.0
        for i in range(len(text)):
            for k in range(ppm.ORDER, -1, -1):
                gram = data[i + ppm.ORDER - k : i + ppm.ORDER + 1]
                after = {g: n for g, n in seen[k].items() if g[:-1] == gram[:-1]}
                if not after:
                    continue
                n, d = sum(after.values()), len(after)
                if gram in after:
                    total += np.log2((n + d) / after[gram])
                    break
                total += np.log2((n + d) / d)
            else:
                total += 8
        return total

    texts = [b"abra", b"zzz", b"cadabra alak", b"q"]
    assert np.allclose(ppm.code_lengths(texts, [tree])[:, 0], [bits(t) for t in texts])


# 10 mixing


def test_mixing(docs, rows, none):
    got = mixing.plan_mix(docs).toPandas()
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    budget = 1.5 * sum(size.values())
    while True:
        level = (budget - sum(target.values())) / max(1, sum(weight[s] for s in open_))
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            break
        target |= {s: 2.0 * size[s] for s in full}
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all() and (got.taken == got["size"] * got.copies).all()
    for s in names:
        part = got[got.source.isna()] if s is None else got[got.source == s]
        assert part.target.iloc[0] == pytest.approx(target[s]) and part.source_size.iloc[0] == size[s] == part["size"].sum()
        assert abs(part.taken.sum() - target[s]) <= part["size"].max() + 0.15 * target[s]
    again = mixing.plan_mix(docs.repartition(2)).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, again[key].values.tolist())) == sorted(map(str, got[key].values.tolist()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == got.copies.sum()
    assert mixing.mix(none).count() == 0 and mixing.plan_mix(none).count() == 0


# contract queries and pipeline


def test_registered_queries(spark, sf):
    from lodeweave.llm import registry
    from tests import oracle

    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries()) == list(range(1, 11))
    con = oracle.connect(sf)
    for name, f in registry.queries().items():
        df = f(spark, sf)
        if sql := registry.oracle_sql().get(name):
            oracle.same(df, con, sql)
        elif not name.startswith("op1_"):
            assert df.count() == n


def test_pipeline_against_its_parts(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs
    for name, stage in p.STAGES[:-1]:
        before, rows = rows, stage(spark, rows, sf).cache()
        assert rows.columns == docs.columns
        assert rows.exceptAll(before if name != p.STAGES[3][0] else before.unionByName(before)).count() == 0
        texts = [r["text"] for r in rows.select("text").collect()]
        if name == "exact dedup":
            assert len(texts) == len(set(texts)) == before.select("text").distinct().count()
        if name == "n-gram Jaccard join":
            top = classes({r["doc_id"]: shingles(r["text"], 5) for r in before.collect()}, 80, 100)
            assert sorted(r["doc_id"] for r in rows.collect()) == sorted(set(top.values()))
    packed = p.STAGES[-1][1](spark, rows, sf).toPandas()
    encode = packing.Encoder(*packing.default_vocab())
    assert packed.length.sum() == sum(len(encode(t)) for t in texts)
    assert p.run(spark, sf).agg(F.sum("length")).first()[0] == packed.length.sum()
