import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lodeweave.functions.columns import any_time, drop_first_match, entity_hash, front_matter, human_number, info_hash
from lodeweave.functions.vocab import NAMESPACES, RDF_TYPE
from lodeweave.operators import extract, graph, mapping, markdown, matching, objects, search
from lodeweave.sources import readers, writers

S = NAMESPACES["schema"]


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("ident", ["plain/name", 'q"uo\\te', "línea\n", "emoji 😀 ü", ""])
def test_entity_hash_is_that_of_canonical_json(spark, ident):
    expected = hashlib.sha256(json.dumps({"platform": "p", "type": "T", "id": ident}, sort_keys=True).encode()).hexdigest()
    assert one(spark, entity_hash("p", "T", F.lit(ident))) == expected


def test_small_functions(spark):
    assert one(spark, human_number(F.lit("1.5K likes"))) == 1500
    assert one(spark, human_number(F.lit("none"))) == 0
    assert one(spark, drop_first_match(F.lit("---a---b---c---"), "(?s)---.*?---")) == "b---c---"
    assert one(spark, front_matter(F.lit("x\n---\na: 1\n---\ny"))).strip() == "a: 1"
    assert one(spark, info_hash(F.lit("m"), F.lit(0.900001))) == one(spark, info_hash(F.lit("m"), F.lit(0.9)))
    for text in ("2024-07-16_09-14-40", "20240716_091440", "2024-07-16T09:14:40", "2024-07-16T09:14:40.123456", "2024-07-16T09:14:40Z"):
        assert str(one(spark, any_time(F.lit(text)))) == "2024-07-16 09:14:40"
    assert one(spark, any_time(F.lit("soon"))) is None


def test_tags(spark):
    models = spark.createDataFrame([("m", ["dataset:x", "arxiv:1234.5678", "base_model:finetune:o/m", "en", "PyTorch", "image-to-text", "Fun", "region:us"], "text-generation"), ("n", [], None)], "entity string, tags array<string>, pipeline_tag string")
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    rows = {r["entity"]: r for r in extract.classify_tags(models, names("en"), names("pytorch"), names("image to text")).collect()}
    r = rows["m"]
    assert (r["datasets"], r["articles"], r["base_models"], r["languages"]) == (["x"], ["https://arxiv.org/abs/1234.5678"], ["o/m"], ["en"])
    assert r["tasks"] == ["image to text", "text generation"] and r["keywords"] == ["fun", "image-to-text", "pytorch", "text generation"]
    assert rows["n"]["keywords"] == [] and rows["n"]["tasks"] == []


def test_yaml_and_rules(spark):
    df = spark.createDataFrame([("license: mit\ntags:\n- a",), ("[1",), ("just text",)], "y string")
    got = [r[0] for r in df.select(extract.yaml_json()(F.col("y"))).collect()]
    assert json.loads(got[0]) == {"license": "mit", "tags": ["a"]} and got[1:] == [None, None]
    with pytest.raises(KeyError):
        mapping.compile_rules(df, [("t", "no_such", "{}")])
    with pytest.raises(json.JSONDecodeError):
        mapping.compile_rules(df, [("t", "find_value", "{bad")])


@pytest.mark.parametrize(
    "lines, end",
    [(["```python", "code", "```"], 2), (["|a|b|", "|-|-|", "|1|2|"], 2), (["> quote", "> line"], 1), (["- item1", "- item2", "  - subitem"], 2), (["1. item1", "2. item2"], 1), (["plain", "text"], None), (["- a", ""], None), (["```", "open"], 1)],
)
def test_blocks(lines, end):
    assert markdown.block_end(lines, 0) == end


def test_sections():
    text = "lead\n# Header 1\nbody\n\n## Header 1.1\nmore\n```\n# no header\n```\n# Header 2\nlast\n# "
    got = markdown.header_sections(text)
    assert [s.title for s in got] == ["Header 1", "Header 1 > Header 1.1", "Header 2"]
    assert got[0].content == "Header 1:\nbody" and "# no header" in got[1].content
    assert markdown.header_sections("no header\n\nat all")[0] == ("", "no header\nat all", 0, 2)
    fine = markdown.fine_sections("para\n\n|a|b|\n|-|-|\n|1|2|\n|3|4|\n|5|6|\nnext line", "T")
    assert [s.title for s in fine] == ["T - Par. 1", "T - Table", "T - Par. 3"]
    assert fine[1].content.endswith("|3|4|\n...") and fine[2].content == "next line"
    assert markdown.trim_blocks("- a\n- b\n- c\nend of list", 2) == "- a\n- b\n..."
    assert all(s.title for s in markdown.hierarchical_sections(text))
    assert [c.content for c in markdown.chunk_sections("abcdef", 4)] == ["abcd", "ef"]


def test_answers(spark):
    text = "1. BERT\n2. a dataset\nthat goes on\n9. out of range"
    assert matching.parse_answers(text, 3) == ["BERT", "a dataset that goes on", ""]
    assert one(spark, matching.answers(F.lit("1. BERT\nAnswer 2: x"), 3)) == ["BERT", "x", ""]
    asked = spark.createDataFrame([("q", "some text"), ("q", "")], "question string, context string")
    got = {r["context"]: r["answer"] for r in matching.answer_questions(asked, lambda ps: [p[-7:] for p in ps], F.lit("t")).collect()}
    assert got == {"some text": "Answer:", "": "No context to answer the question"}


def test_question_groups():
    groups = matching.group_questions([[1, 0], [0.9, 0.1], [0, 1], [0.1, 0.9]], 2)
    assert sorted(map(sorted, groups)) == [[0, 1], [2, 3]]


def test_strategies(spark):
    sections = spark.createDataFrame([(1, 0, "the license is mit"), (1, 1, "trained on images")], "doc_id long, pos int, content string")
    asks = spark.createDataFrame([("p", "which license")], "property string, question string")
    r = matching.extract_properties(sections, asks, "context_matching").first()
    assert r["data"] == "the license is mit" and r["method"] == "DirectContextMatch_SectionContent"
    r = matching.extract_properties(sections, asks, "grouped", lambda ps: ["mit" for _ in ps], 1, time=F.lit("t")).first()
    assert (r["data"], r["method"]) == ("mit", "grouped_qa")
    with pytest.raises(ValueError):
        matching.extract_properties(sections, asks, "individual")


def test_grouped_questions_are_asked_together(spark):
    sections = spark.createDataFrame([(1, 0, "the license is mit"), (1, 1, "trained on images"), (2, 0, "the license is bsd"), (3, 0, "")], "doc_id long, pos int, content string")
    asks = spark.createDataFrame([("p1", "which license is it"), ("p2", "which license is used"), ("q1", "trained on images"), ("q2", "trained on what images")], "property string, question string")

    def model(prompts):
        out = []
        for p in prompts:
            context, asked = p.split("\n\nQuestions:\n")
            asked = asked.split("\n\n")[0].split("\n")
            assert len(asked) == 2 and asked[0].startswith("1. ") and asked[1].startswith("2. ")
            out.append("\n".join(f"{q} <- {context.split(chr(10))[1]}" for q in asked))
        return out

    got = {(r["doc_id"], r["property"]): (r["data"], r["method"]) for r in matching.extract_properties(sections, asks, "grouped", model, 1, most=2).collect()}
    assert len(got) == 12 and {m for _, m in got.values()} == {"grouped_qa"}
    assert got[1, "p2"][0] == "which license is used <- the license is mit" and got[1, "q1"][0] == "trained on images <- trained on images"
    assert got[2, "q2"][0] == "trained on what images <- the license is bsd" and got[3, "p1"][0] == "No context to answer the question"


TTL = """@prefix schema: <https://schema.org/> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
<urn:a> a schema:Thing ; schema:name "A \\"q\\""@en, 'x' .
""".replace(", 'x'", "") + """[] a schema:Person ; schema:age 5 ; schema:score "0.9"^^xsd:float ; schema:knows [ schema:name \"\"\"long
text\"\"\" ] .
# comment
schema:b schema:ok true .
"""


def test_turtle(spark, tmp_path):
    rows = readers.parse_turtle(TTL)
    assert ("urn:a", RDF_TYPE, S + "Thing", "uri", None, None) in rows and ("urn:a", S + "name", 'A "q"', "literal", None, "en") in rows
    assert any(r[1] == S + "score" and r[4].endswith("float") for r in rows) and any(r[2] == "long\ntext" for r in rows)
    assert len(rows) == 8 and readers.parse_turtle("") == []
    (tmp_path / "x.ttl").write_text(TTL)
    assert readers.turtle(spark, str(tmp_path / "x.ttl")).count() == 8
    t = readers.turtle(spark, str(tmp_path / "x.ttl")).filter("o_kind <> 'bnode' AND s NOT LIKE '\\\\_:%' AND o_lang is null").drop("o_lang")
    writers.write_turtle(t, str(tmp_path / "out"))
    back = readers.turtle(spark, str(tmp_path / "out")).drop("o_lang")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, t.collect()), key=repr)


def test_ntriples_roundtrip(spark, tmp_path):
    t = spark.createDataFrame([("urn:a", "urn:p", 'x "y" \\ \n z', "literal", None), ("urn:a", "urn:p", "urn:b", "uri", None), ("_:b", "urn:p", "1", "literal", "urn:int")], "s string, p string, o string, o_kind string, o_dtype string")
    writers.write_ntriples(t, str(tmp_path / "nt"))
    assert sorted(map(tuple, readers.ntriples(spark, str(tmp_path / "nt")).drop("o_lang").collect()), key=repr) == sorted(map(tuple, t.collect()), key=repr)


def test_chunks_keep_subjects_whole(spark, tmp_path):
    t = spark.range(60).select(F.concat(F.lit("urn:"), (F.col("id") % 20).cast("string")).alias("s"), F.lit("urn:p").alias("p"), F.col("id").cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(None).cast("string").alias("o_dtype"))
    chunks = graph.subject_chunks(t, 50)
    assert chunks.count() == 20 and chunks.agg(F.sum("n")).first()[0] == 60
    sizes = [r["n"] for r in chunks.groupBy("chunk_id").agg(F.sum("n").alias("n")).orderBy("chunk_id").collect()]
    assert all(n * 7 >= 50 for n in sizes[:-1]) and max(sizes) <= 9
    assert graph.subject_chunks(t, 0).select("chunk_id").distinct().count() == 1
    meta = t.withColumn("method", F.lit("m"))
    assert writers.write_chunks(t, meta, 50, str(tmp_path / "c")).agg(F.sum("triples")).first()[0] == 60


def test_graph_algebra(spark):
    with pytest.raises(ValueError):
        graph.union_graphs()
    rows = spark.createDataFrame([("s", "p", "o", "literal", None, "m1", 0.5, 3), ("s", "p", "o", "literal", None, "m2", 0.9, 1), ("s", "p", "o", "uri", None, "m3", 0.1, 9)], "s string, p string, o string, o_kind string, o_dtype string, method string, confidence double, extraction_time long")
    best = {r["o_kind"]: r["method"] for r in graph.disambiguate(rows).collect()}
    assert best == {"literal": "m2", "uri": "m3"}
    assert graph.disambiguate(graph.disambiguate(rows)).count() == 2


def test_object_branches(spark):
    ranges = [("Text", "text"), ("Date or DateTime", "date"), ("Dataset or croissant:Dataset", "dataset"), ("DatasetObject", "dataset_object"), ("EvalutionObject", "evaluation"), ("Person or Organization", "person"), ("CreativeWork or URL", "url"), ("Grant", "string"), ("Language or Text", "text"), (None, "string")]
    df = spark.createDataFrame(ranges, "r string, b string")
    assert df.filter(objects.branch_of(F.col("r")) != F.col("b")).count() == 0


BOOKS = [("Spark in depth", "about clusters and data", 300, [("Ann", 40)]), ("Data mining", "data and patterns", 150, [("Bob", 30), ("Cy", 55)]), ("Gardens", "plants", 90, [])]


def test_search(spark):
    df = spark.createDataFrame(BOOKS, "title string, content string, pages int, author array<struct<name:string,age:int>>")
    hits = lambda c: sorted(r["title"] for r in df.filter(c).collect())
    assert hits(search.match(F.col("content"), "Data plants")) == ["Data mining", "Gardens", "Spark in depth"]
    assert hits(search.match_phrase(F.col("content"), "and data")) == ["Spark in depth"]
    assert hits(search.bool_query(must=[search.match(F.col("content"), "data")], filters=[search.in_range(F.col("pages"), gte=150, lt=300)])) == ["Data mining"]
    assert hits(search.nested(F.col("author"), lambda a: search.in_range(a["age"], gt=50))) == ["Data mining"]
    assert one(spark, search.edge_ngrams(F.lit("Bert"))) == ["ber", "bert"] and one(spark, search.edge_ngrams(F.lit("ab"))) == []


def test_cells_json(spark, tmp_path):
    cell = lambda d: [{"data": d, "extraction_method": "m", "confidence": 0.9, "extraction_time": "t"}]
    (tmp_path / "c.json").write_text(json.dumps([{"schema.org:name": cell("a"), "fair4ml:mlTask": cell(["x", "y"])}, {"schema.org:name": cell("b")}]))
    rows = sorted((r["entity"], r["property"], r["pos"], r["data"]) for r in readers.cells_json(spark, str(tmp_path / "c.json")).collect())
    assert rows == [("a", "fair4ml:mlTask", 0, "x"), ("a", "fair4ml:mlTask", 1, "y"), ("a", "schema.org:name", 0, "a"), ("b", "schema.org:name", 0, "b")]


def test_lists(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# c\n\nowner/name\n plain \n")
    assert sorted(r[0] for r in readers.model_list(spark, str(tmp_path / "m.txt")).collect()) == ["name", "plain"]
    (tmp_path / "t.tsv").write_text("tag_name\tdescription\nPyTorch\tx\n")
    assert readers.tsv_list(spark, str(tmp_path / "t.tsv"), lower=True).first()[0] == "pytorch"
