"""The pipeline on odd rows, and its quality, mixing and packing stages by definition."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from lodeweave.llm import mixing, packing, quality
from tests.llm.test_operators import WORD, frame

GOOD = "The committee met on Tuesday to discuss the budget, and after a long debate its members agreed on most of the points. "


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Labels that call prose good and noise bad."""
    path = tmp_path_factory.mktemp("sf")
    pq.write_table(pa.table({"doc_id": pa.array(range(400), pa.int64()), "quality": pa.array([int(i % 3 != 0) for i in range(400)], pa.int32()), "toxic": pa.array([0] * 400, pa.int32())}), path / "labels.parquet")
    return str(path)


def rows():
    rng = random.Random(12)
    words = sorted(set(GOOD.lower().split()))
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    noise = lambda: " ".join(rng.choice(["$$%%", "||", "##", "zz9q8", "@@@@"]) for _ in range(60))
    out = [(i, prose(rng.randint(40, 90)) if i % 3 else noise(), "en", rng.choice("ab")) for i in range(400)]
    base = prose(80)
    out += [(500, base, "en", "a"), (501, base, "en", "b"), (502, base + " Amen.", None, "a"), (501, base, "en", "b"), (None, base, "en", "a"), (None, prose(50), "en", None)]
    out += [(600, None, "en", "a"), (601, "", "en", "a"), (602, " " * 10**6, "en", "a"), (603, "=" * 10**6 + "a", "en", "a"), (604, (GOOD * 2000), "en", "a"), (605, prose(60), None, None), (605, prose(70), "en", "a")]
    return out


def test_stages_by_definition(spark, folder):
    docs = frame(spark, rows()).repartition(3)
    names = dict(p.STAGES)
    good = names["quality classifier"](spark, docs, folder).cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    kept = [r["text"] for r in docs.collect() if model.score(quality.np.array([quality.features(r["text"])]))[0] >= 0.5]
    assert good.columns == docs.columns and sorted(map(str, (r["text"] for r in good.collect()))) == sorted(map(str, kept))
    assert sum(r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] % 3 == 0 for r in good.collect()) == 0
    assert sum(r["doc_id"] is not None and r["doc_id"] < 400 for r in good.collect()) > 260
    exact = names["exact dedup"](spark, good, folder).cache()
    assert exact.count() == len({t or "" for t in kept})
    near = names["n-gram Jaccard join"](spark, exact, folder).cache()
    left = [r["doc_id"] for r in near.collect()]
    assert 501 in left and 502 not in left and left.count(605) == 2
    mixed = names["mixing sources to target weights"](spark, near, folder).cache()
    plan = {(r["doc_id"], r["size"], r["source"]): r["copies"] for r in mixing.plan_mix(near).collect()}
    got = {}
    for r in mixed.collect():
        key = (r["doc_id"], len(WORD.findall(r["text"] or "")), r["source"])
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in plan.items() if n} and mixed.columns == docs.columns
    packed = names["packing"](spark, mixed, folder).toPandas()
    encode = packing.Encoder(*packing.default_vocab())
    assert packed.length.sum() == sum(len(encode(r["text"] or "")) for r in mixed.collect())
    used = packed.groupby("sequence_id").length.sum()
    assert (used == 2048).sum() == packed.length.sum() // 2048 and used.max() <= 2048


def test_empty_table(spark, folder):
    docs = frame(spark, []).filter("doc_id is not null")
    for _, stage in p.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
