from pyspark.sql import functions as F

from lodeweave.operators import tables
from lodeweave.plans.flows import Settings, crawl_base_models, extract_records, load, transform
from lodeweave.operators.store import Store, current_graph


def test_row_operations(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    grown, new = tables.insert(t, spark.createDataFrame([("d\u0000",), ("c",)], "k string"), "k")
    assert sorted(map(tuple, grown.select("id", "k").collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "d�")]
    assert sorted(r["id"] for r in new.collect()) == [3, 4]
    assert sorted(r["k"] for r in tables.update(t, F.col("id") == 2, {"k": F.lit("z")}).collect()) == ["a", "z"]
    assert sorted(r["k"] for r in tables.update_from(t, spark.createDataFrame([(1, "y")], "id long, k string"), ["id"]).collect()) == ["b", "y"]
    assert [r["k"] for r in tables.delete(t, F.col("id") == 2).collect()] == ["a"] and tables.truncate(t).count() == 0
    assert tables.run_sql(spark, "SELECT k FROM {t} WHERE id = :i", {"t": t}, {"i": 2}).first()["k"] == "b"


def test_a_flow_reaches_the_store(spark):
    settings = Settings("ai4life", "2024-01-02_03-04-05")
    records = spark.createDataFrame([("m1", "Model", '{"manifest": {"name": "Net", "tags": ["x"]}}'), ("d1", "dataset", "{}")], "id string, type string, doc string")
    long = extract_records(records, {"schema.org:name": ["manifest.title", "manifest.name"], "schema.org:keywords": ["manifest.tags[0]"]}, settings)
    schema = spark.createDataFrame([("schema.org:name", "Text", 0), ("schema.org:keywords", "DefinedTerm", 1)], "property string, real_range string, file_order int")
    store, docs = load(Store.empty(spark), transform(long, schema, settings))
    doc = docs.first()
    assert (doc["name"], doc["keywords"]) == ("Net", ["x"]) and docs.count() == 1
    assert current_graph(store.triplets, store.ranges).count() == store.triplets.count() == 5


def test_crawl_depth_zero_is_the_start(spark):
    chain = spark.createDataFrame([("a", ["base_model:b"]), ("b", []), ("c", [])], "modelId string, tags array<string>")
    assert [r["modelId"] for r in crawl_base_models(chain.filter("modelId = 'a'"), chain, 0).collect()] == ["a"]
    assert sorted(r["modelId"] for r in crawl_base_models(chain.filter("modelId = 'a'"), chain, 1).collect()) == ["a", "b"]
