"""Malformed records, platform documents, chunked loads, answers beside their rows, and what survives a broken writer."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeweave.functions.vocab import NAMESPACES, RDF_TYPE
from lodeweave.operators import extract, graph, mapping, matching, search, store as stores, tables
from lodeweave.operators.store import Store
from lodeweave.plans import flows
from lodeweave.sources import readers, scratch, writers

S, FAIR = NAMESPACES["schema"], NAMESPACES["fair4ml"]
TRIPLE = "s string, p string, o string, o_kind string, o_dtype string"


def test_repeated_keys_and_numbers_do_not_end_the_job(spark):
    rows = spark.createDataFrame([("license: a\nlicense: b\nother: x",), ("plain",), ("license:\n- mit\n- apache-2.0\nextra_gated_fields:\n  Name: text\n",)], "block string")
    got = rows.select(extract.flat_yaml(F.col("block")).alias("flat"), extract.yaml_fields(F.col("block")).alias("all")).collect()
    assert got[0]["flat"] == {"license": "b", "other": "x"} and got[0]["all"] == {"license": "b", "other": "x"}
    assert got[1]["flat"] == {} and got[1]["all"] is None
    assert json.loads(got[2]["all"]["license"]) == ["mit", "apache-2.0"] and json.loads(got[2]["all"]["extra_gated_fields"]) == {"Name": "text"}
    spdx = spark.createDataFrame([("MIT", "MIT License")], "identifier string, name string")
    fields = rows.select(F.monotonically_increasing_id().cast("string").alias("entity"), extract.yaml_fields(F.col("block")).alias("fields"))
    assert sorted(str(r["licence"]) for r in extract.licence_info(fields, spdx).collect()) == ["MIT", "None", "b\nlicense: b"]
    text = spark.createDataFrame([("1. one\n1. again\n3) three",)], "r string")
    assert text.select(matching.answers(F.col("r"), 3).alias("a")).first()["a"] == ["one", "", "three"]


def test_leaves_of_json(spark):
    deep = json.dumps({"a": 1})
    for _ in range(120):
        deep = json.dumps({"n": json.loads(deep)})
    rows = spark.createDataFrame([(1, '{"a": {"b": 1.50, "c": [1, {"d": "x y"}], "e": null}, "f": true, "g": "t"}'), (2, "no json"), (3, None), (4, "[1]"), (5, deep)], "k long, doc string")
    got = {(r["k"], r["path"]): r["value"] for r in mapping.flatten_json(rows, "k", "doc").collect()}
    assert got == {(1, "a.b"): "1.50", (1, "a.c"): '[1,{"d":"x y"}]', (1, "a.e"): None, (1, "f"): "true", (1, "g"): "t", (5, ".".join(["n"] * 120 + ["a"])): "1"}


def test_a_broken_writer_leaves_the_store_as_it_was(spark, tmp_path):
    path = str(tmp_path / "store")
    batch = spark.createDataFrame([("<s>", "<p>", '"a"', "m", 1.0)], "subject string, predicate string, object string, method string, confidence double").withColumn("time", F.lit("2024-01-01").cast("timestamp_ntz"))
    first = Store.empty(spark).apply(batch).save(path)
    os.makedirs(f"{path}/_writing-half/triplets")  # what a writer that died leaves
    assert stores.versions(spark, path) == [1] and Store.load(spark, path).triplets.count() == first.triplets.count() == 1
    assert stores.versions(spark, path) == [1] and first.apply(batch).save(path).ranges.count() == 1
    assert stores.versions(spark, path) == [1, 2] and Store.load(spark, path, 1).ranges.count() == 1
    Store.load(spark, path).export(str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['<s> <p> "a" .']
    stores.reset(spark, path)
    assert stores.versions(spark, path) == [] and Store.load(spark, path).triplets.count() == 0


def test_ids_by_any_number_of_digits(spark):
    new = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("k"))
    taken = spark.createDataFrame([(7, "x")], "id long, k string")
    for digits in (1, 2, 4):
        got = stores.allocate_ids(new, taken, "k", digits).orderBy("k").collect()
        assert [r["id"] for r in got] == list(range(8, 308))
    assert [stores.digits_for(n) for n in (0, 10**6, 10**9, 10**15)] == [2, 2, 4, 6]


def test_scratch_space_is_given_back(spark, tmp_path):
    with scratch.scratch_space():
        scratch.materialize(spark.range(3), "kept")
        path = scratch._written[-1][1]
        assert os.path.exists(path)
    assert not os.path.exists(path)


def graph_rows(spark, platform):
    e = "https://x.org/"
    rows = [(e + "m", RDF_TYPE, FAIR + "MLModel", "uri", None), (e + "m", S + "name", "Net", "literal", None), (e + "m", FAIR + "trainedOn", e + "d", "uri", None), (e + "d", S + "name", "Data", "literal", None), (e + "m", S + "license", "MIT", "literal", None)]
    rows += [(e + "m", S + "keywords", k, "literal", None) for k in ("b", "a")] + [(e + "m", FAIR + "mlTask", "Vision", "literal", None), (e + "m", FAIR + "modelCategory", "CNN", "literal", None)]
    if platform == "huggingface":
        rows.append((e + "m", S + "identifier", "https://huggingface.co/own/net", "literal", None))
    return spark.createDataFrame(rows, TRIPLE)


def test_platform_documents(spark):
    hf = search.platform_documents(graph_rows(spark, "huggingface"), "huggingface").first()
    assert (hf["name"], hf["license"], hf["keywords"], hf["relatedDatasets"], hf["mlTask"], hf["releaseNotes"], hf["index"]) == ("own/net", "mit", ["a", "b"], ["Data"], ["vision"], "", "hf_models")
    run = search.platform_documents(graph_rows(spark, "open_ml"), "open_ml").first()
    assert (run["name"], run["license"], run["trainedOn"], run["modelCategory"], run["index"]) == ("Net", "information not found", ["Data"], ["cnn"], "openml_models")
    bio = search.platform_documents(graph_rows(spark, "ai4life"), "ai4life").first()
    assert (bio["license"], bio["relatedDatasets"], bio["sharedBy"], bio["index"]) == ("mit", ["Data"], "", "ai4life_models")
    empty = search.create_index(spark, "ai4life")
    assert empty.count() == 0 and set(empty.columns) == set(search.platform_documents(graph_rows(spark, "ai4life"), "ai4life").columns)
    docs = search.platform_documents(graph_rows(spark, "ai4life"), "ai4life")
    assert search.create_index(spark, "ai4life", docs) is docs
    assert search.bulk_rows(docs, "i").first()["_index"] == "i" and "_index" not in search.property_names(search.bulk_rows(docs, "i"))
    changed = search.update_fields(docs, docs.select("db_identifier", F.lit("you").alias("sharedBy")).unionByName(docs.select(F.lit("other").alias("db_identifier"), F.lit("x").alias("sharedBy"))))
    assert [(r["sharedBy"], r["name"]) for r in changed.collect()] == [("you", "Net")]
    assert search.search(docs, None).count() == 1 and search.search(docs, search.match(F.col("name"), "other")).count() == 0
    frame = spark.createDataFrame([("Net", ["t"])], "`schema.org:name` string, `fair4ml:mlTask` array<string>")
    assert search.frame_documents(frame, F.lit("u")).first().asDict() == {"db_identifier": "u", "name": "Net", "releaseNotes": "", "mlTask": ["t"], "author": [], "index": "hf_models"}


@pytest.mark.parametrize("size", [1, 30, 0])
def test_chunked_load_leaves_what_one_load_leaves(spark, tmp_path, size):
    rows = graph_rows(spark, "huggingface").withColumns({"method": F.lit("m"), "confidence": F.lit(1.0), "extraction_time": F.lit("2024-01-02_03-04-05")})
    once, docs = flows.load(Store.empty(spark), rows)
    path = str(tmp_path / "s")
    store, again = flows.load_in_chunks(Store.empty(spark), rows, size, path)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(store.current()) == key(once.current()) and key(docs) == key(again)
    assert len(stores.versions(spark, path)) == (2 if size == 1 else 1)
    more, _ = flows.load_in_chunks(store, rows, size, path)  # the same again
    assert key(more.current()) == key(once.current()) and more.ranges.count() == store.ranges.count()


def test_jsonld_and_metadata(spark, tmp_path):
    rows = graph_rows(spark, "huggingface").unionByName(spark.createDataFrame([("https://x.org/q", S + "name", 'a "quoted"\ttext', "literal", NAMESPACES["xsd"] + "string")], TRIPLE))
    nodes = {r["subject"]: json.loads(r["value"]) for r in writers.jsonld_nodes(rows).collect()}
    assert nodes["https://x.org/m"]["@type"] == [FAIR + "MLModel"] and nodes["https://x.org/m"][FAIR + "trainedOn"] == [{"@id": "https://x.org/d"}]
    assert nodes["https://x.org/q"][S + "name"] == [{"@type": NAMESPACES["xsd"] + "string", "@value": 'a "quoted"\ttext'}]
    statements = rows.withColumns({"method": F.lit("m"), "confidence": F.lit(0.5), "extraction_time": F.lit("t")})
    manifest = writers.write_chunks(rows, statements, 1, str(tmp_path / "c"))
    assert manifest.count() == 3
    meta = readers.ntriples(spark, str(tmp_path / "c" / "metadata"))
    assert meta.count() == 7 * rows.count() and meta.filter(F.col("p").endswith("meta/confidence")).select("o").distinct().collect()[0]["o"] == "0.5"


def test_blocks_give_the_same_best_items(spark):
    rng = np.random.default_rng(1)
    vecs = np.round(rng.normal(size=(90, 5)), 1)
    vecs[7] = 0
    items = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<double>").repartition(3)
    asks = items.filter("id % 3 = 0").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    got = {(r["q"], r["rank"]): (r["id"], r["score"]) for r in matching._top_k_blocks(asks, items, 4, "q", "qv", "id", "v", 6, block=16).collect()}
    norm = np.linalg.norm(vecs, axis=1)
    for q in range(0, 90, 3):
        score = np.round(np.divide(vecs @ vecs[q], norm * norm[q], out=np.zeros(90), where=norm * norm[q] != 0), 6)
        best = sorted(range(90), key=lambda i: (-score[i], i))[:4]
        assert [got[q, r + 1][0] for r in range(4)] == best and np.allclose([got[q, r + 1][1] for r in range(4)], score[best])


def test_documents_without_sections_match_as_a_whole(spark):
    sections = spark.createDataFrame([("a", 0, "license mit"), ("a", 1, "training data")], "doc_id string, pos int, content string")
    docs = spark.createDataFrame([("a", "x"), ("b", "the whole text"), ("c", "")], "doc_id string, text string")
    asks = spark.createDataFrame([("p1", "what license"), ("p2", "what training data")], "property string, question string")
    all_ = matching.with_whole_texts(sections, docs)
    got = {(r["doc_id"], r["property"]): (r["data"], r["confidence"]) for r in matching.extract_properties(all_, asks, "context_matching").collect()}
    assert got[("b", "p1")] == got[("b", "p2")] == ("the whole text", 1.0) and got[("a", "p1")][0] == "license mit" and not any(d == "c" for d, _ in got)
    wide = {r["doc_id"]: r for r in matching.question_columns(docs, "doc_id", "text", sections, asks).collect()}
    assert wide["a"]["p2"]["data"] == "training data" and wide["b"]["p1"]["confidence"] == 1.0 and wide["c"]["p1"] is None
    with pytest.raises(ValueError):
        matching.small_questions(spark.range(matching.MOST_QUESTIONS + 1))


def test_queries_and_their_statistics(spark):
    log = tables.QueryLog(spark)
    t = spark.createDataFrame([(1,), (2,)], "x int")
    assert log.run("SELECT sum(x) AS s FROM {t}", {"t": t}).first()["s"] == 3
    assert [r.count() for r in log.batch([("SELECT * FROM {t}", {"t": t}), ("SELECT * FROM {t} WHERE x > :n", {"t": t}, {"n": 1})])] == [2, 1]
    log.run("SELECT * FROM {t}", {"t": t})
    stats = {r["sql"]: r for r in log.statistics().collect()}
    assert stats["SELECT * FROM {t}"]["runs"] == 2 and stats["SELECT * FROM {t}"]["mean_seconds"] > 0


def test_path_mappings_and_results(spark, tmp_path):
    runs = spark.createDataFrame([(1, "d", None)], "id int, name string, tag string")
    got = runs.select(mapping.map_paths({"url": "https://o.org/{id}/{tag}", "names": ["name", "run {id}"], "one": "name"}).alias("m")).first()["m"]
    assert (got["url"], got["names"], got["one"]) == ("https://o.org/1/", ["d", "run 1"], "d")
    with pytest.raises(FileNotFoundError):
        readers.path_schema(str(tmp_path / "no"))
    (tmp_path / "empty").write_text("{}")
    with pytest.raises(ValueError):
        readers.path_schema(str(tmp_path / "empty"))
    x = NAMESPACES["xsd"]
    result = json.dumps({"head": {"vars": ["s", "n"]}, "results": {"bindings": [{"s": {"type": "uri", "value": "urn:a"}, "n": {"type": "literal", "datatype": x + "integer", "value": "3"}}, {"s": {"type": "uri", "value": "urn:b"}}]}})
    frame = readers.sparql_frame(spark.createDataFrame([(result,)], "value string"), ["s", "n"])
    assert dict(frame.dtypes) == {"s": "string", "n": "bigint"} and sorted(map(tuple, frame.collect())) == [("urn:a", 3), ("urn:b", None)]
    with pytest.raises(ValueError):
        extract.small_vocabulary(spark.range(extract.MOST_NAMES + 1).select(F.col("id").cast("string").alias("name")))
    with pytest.raises(ValueError):
        extract.specific(runs, "name", [], [F.col("id")])
    assert extract.specific(runs, "name", ["d"], [F.col("id")]).count() == 1
    sets = spark.createDataFrame([("d", "n", [("x",)], [("r", [("f", "int"), ("g", "text")])])], "dataset_id string, name string, distribution array<struct<name:string>>, record_set array<struct<name:string,field:array<struct<name:string,dataType:string>>>>")
    rows = {r["part"]: r for r in mapping.croissant_rows(sets).collect()}
    assert (rows["record_set"]["field_name"], rows["record_set"]["field_type"], rows["distribution"]["field_name"]) == ("g", "text", None)


def test_names_come_from_the_whole_graph(spark):
    rows = graph_rows(spark, "open_ml")
    part = graph.resolve_names(rows.filter(F.col("s") == "https://x.org/m"), [FAIR + "trainedOn"], named=rows)
    assert part.filter(F.col("p") == FAIR + "trainedOn").first()["shown"] == "Data"
