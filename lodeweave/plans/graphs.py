"""Graph queries: entity names, typed objects, provenance, rewriting, set algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.functions.columns import article_id, entity_hash, entity_uri, humanize, predicate_uri
from lodeweave.functions.vocab import BASE, NAMESPACES, RDF_TYPE
from lodeweave.operators import extract, graph, objects
from lodeweave.plans.registry import query, table
from lodeweave.sources.scratch import scratch_path

S, FAIR, XSD = NAMESPACES["schema"], NAMESPACES["fair4ml"], NAMESPACES["xsd"]


def uri_sql(kind: str, ident: str, platform: str = "huggingface") -> str:
    return f"""'{BASE}' || sha256('{{"id": "' || {ident} || '", "platform": "{platform}", "type": "{kind}"}}')"""


def customer_triples(spark, d):
    """Customers as models: type, name, segment, nation (an entity), balance."""
    c = table(spark, d, "customer")
    s = entity_uri("huggingface", "MLModel", F.col("c_name"))
    nation = entity_uri("huggingface", "Dataset", F.col("c_nationkey").cast("string"))
    t = lambda p, o, k="literal", dt=XSD + "string": F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(k).alias("o_kind"), F.lit(dt).cast("string").alias("o_dtype"))
    rows = F.array(
        t(RDF_TYPE, F.lit(FAIR + "MLModel"), "uri", None),
        t(S + "name", F.col("c_name")),
        t(S + "keywords", F.col("c_mktsegment")),
        t(FAIR + "trainedOn", nation, "uri", None),
    )
    return c.select(s.alias("s"), F.explode(rows).alias("t")).select("s", "t.*")


CUSTOMER_SQL = f"""c AS (SELECT {uri_sql('MLModel', 'c_name')} AS s, c_name, c_mktsegment, {uri_sql('Dataset', 'CAST(c_nationkey AS VARCHAR)')} AS nation FROM customer),
ct AS (SELECT s, '{RDF_TYPE}' AS p, '{FAIR}MLModel' AS o, 'uri' AS o_kind, CAST(NULL AS VARCHAR) AS o_dtype FROM c UNION ALL SELECT s, '{S}name', c_name, 'literal', '{XSD}string' FROM c
  UNION ALL SELECT s, '{S}keywords', c_mktsegment, 'literal', '{XSD}string' FROM c UNION ALL SELECT s, '{FAIR}trainedOn', nation, 'uri', NULL FROM c)"""


def nation_triples(spark, d):
    n = table(spark, d, "nation")
    s = entity_uri("huggingface", "Dataset", F.col("n_nationkey").cast("string"))
    rows = F.array(
        F.struct(F.lit(RDF_TYPE).alias("p"), F.lit(NAMESPACES["cr"] + "Dataset").alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("o_dtype")),
        F.struct(F.lit(S + "name").alias("p"), F.col("n_name").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD + "string").alias("o_dtype")),
    )
    return n.select(s.alias("s"), F.explode(rows).alias("t")).select("s", "t.*")


NATION_SQL = f"""n AS (SELECT {uri_sql('Dataset', 'CAST(n_nationkey AS VARCHAR)')} AS s, n_name FROM nation),
nt AS (SELECT s, '{RDF_TYPE}' AS p, '{NAMESPACES['cr']}Dataset' AS o, 'uri' AS o_kind, CAST(NULL AS VARCHAR) AS o_dtype FROM n UNION ALL SELECT s, '{S}name', n_name, 'literal', '{XSD}string' FROM n)"""


@query(f"""SELECT c_custkey, sha256('{{"id": "' || c_name || '", "platform": "huggingface", "type": "MLModel"}}') AS named, sha256('{{"id": ' || CAST(c_custkey AS VARCHAR) || ', "platform": "open_ml", "type": "Dataset"}}') AS numbered FROM customer""")
def entity_hashes(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", entity_hash("huggingface", "MLModel", F.col("c_name")).alias("named"), entity_hash("open_ml", "Dataset", F.col("c_custkey"), number=True).alias("numbered"))


@query(f"""SELECT * FROM (VALUES ('schema.org:name', '{S}name'), ('FAIR4ML:mlTask', '{FAIR}mlTask'), ('codemeta:readme', '{NAMESPACES['codemeta']}readme'), ('plain', '{BASE}plain'), ('other:x', NULL)) AS t(prop, uri)""")
def predicate_uris(spark, d):
    rows = spark.createDataFrame([(x,) for x in ("schema.org:name", "FAIR4ML:mlTask", "codemeta:readme", "plain", "other:x")], "prop string")
    return rows.select("prop", predicate_uri(F.col("prop")).alias("uri"))


@query("""SELECT * FROM (VALUES ('fair4ml:intendedUse', 'Intended Use'), ('schema.org:name', 'Name'), ('x:snake_case_nameHere', 'Snake Case Name Here')) AS t(prop, label)""")
def property_labels(spark, d):
    rows = spark.createDataFrame([("fair4ml:intendedUse",), ("schema.org:name",), ("x:snake_case_nameHere",)], "prop string")
    return rows.select("prop", humanize(F.col("prop")).alias("label"))


@query(f"WITH {CUSTOMER_SQL} SELECT * FROM ct")
def triples_from_rows(spark, d):
    return customer_triples(spark, d)


RANGES = (
    ("schema.org:name", "Text", 0), ("schema.org:keywords", "DefinedTerm", 1), ("fair4ml:sharedBy", "Person or Organization", 2), ("fair4ml:trainedOn", "Dataset or croissant:Dataset", 3),
    ("schema.org:url", "URL", 4), ("schema.org:license", "CreativeWork", 5), ("fair4ml:fineTunedFrom", "fair4ml:MLModel", 6), ("schema.org:isAccessibleForFree", "Boolean", 7),
    ("schema.org:dateCreated", "Date or DateTime", 8), ("codemeta:referencePublication", "ScholarlyArticle", 9), ("schema.org:name", "URL", 10),
)


def part_cells(spark, d):
    """Parts as models with one cell per property of every object branch."""
    p = table(spark, d, "part")
    text = lambda c: F.col(c).cast("string")
    wide = p.select(
        text("p_partkey").alias("k"), "p_name", "p_brand", "p_type", F.concat(F.lit("https://x.org/"), text("p_partkey")).alias("url"),
        F.when(F.col("p_size") % 2 == 0, "MIT").otherwise("https://l.org/x").alias("lic"), F.lit("true").alias("free"), F.lit("2024-05-06T07:08:09").alias("day"),
        F.concat(F.lit("https://arxiv.org/abs/2101.0"), text("p_size"), F.lit("v2")).alias("art"), F.when(F.col("p_size") % 5 == 0, "None").otherwise(F.col("p_brand")).alias("person"),
    )
    props = {"schema.org:name": "p_name", "schema.org:keywords": "p_type", "fair4ml:sharedBy": "person", "fair4ml:trainedOn": "p_brand", "schema.org:url": "url", "schema.org:license": "lic", "fair4ml:fineTunedFrom": "p_brand", "schema.org:isAccessibleForFree": "free", "schema.org:dateCreated": "day", "codemeta:referencePublication": "art"}
    long = extract.to_long(wide, "k", props, "Parsed", 0.9, F.lit("2024-01-01_00-00-00")).withColumnRenamed("time", "extraction_time")
    return objects.attach_ranges(long, spark.createDataFrame(RANGES, "property string, real_range string, file_order int"))


def _typed_sql() -> str:
    hub = "https://huggingface.co/"
    e = uri_sql
    c = NAMESPACES["cr"]
    lit, t = f"'{XSD}string'", f"'{RDF_TYPE}'"
    rows = [
        (f"'{S}name'", "p_name", "'literal'", lit, ""),
        (f"'{S}keywords'", e("DefinedTerm", "lower(p_type)"), "'uri'", "NULL", ""),
        (f"'{FAIR}sharedBy'", e("Person", "p_brand"), "'uri'", "NULL", "WHERE p_size % 5 <> 0"),
        (f"'{FAIR}trainedOn'", e("Dataset", "p_brand"), "'uri'", "NULL", ""),
        (f"'{S}url'", "'https://x.org/' || CAST(p_partkey AS VARCHAR)", "'uri'", "NULL", ""),
        (f"'{S}license'", f"CASE WHEN p_size % 2 = 0 THEN {e('CreativeWork', chr(39) + 'mit' + chr(39))} ELSE 'https://l.org/x' END", "'uri'", "NULL", ""),
        (f"'{FAIR}fineTunedFrom'", e("MLModel", "p_brand"), "'uri'", "NULL", ""),
        (f"'{S}isAccessibleForFree'", "'true'", "'literal'", f"'{XSD}boolean'", ""),
        (f"'{S}dateCreated'", "'2024-05-06T07:08:09'", "'literal'", f"'{XSD}dateTime'", ""),
        (f"'{NAMESPACES['codemeta']}referencePublication'", e("ScholarlyArticle", "'2101.0' || CAST(p_size AS VARCHAR)"), "'uri'", "NULL", ""),
    ]
    me = e("MLModel", "CAST(p_partkey AS VARCHAR)")
    parts = [f"SELECT {me} AS s, {p} AS p, {o} AS o, {k} AS o_kind, {dt} AS o_dtype FROM part {w}" for p, o, k, dt, w in rows]

    def extra(subject, p, o, k="'literal'", dt=lit, w=""):
        parts.append(f"SELECT {subject}, {p}, {o}, {k}, {dt} FROM part {w}")

    for subject, kind, name, w in (
        (e("DefinedTerm", "lower(p_type)"), S + "DefinedTerm", "p_type", ""), (e("Person", "p_brand"), S + "Person", "p_brand", "WHERE p_size % 5 <> 0"), (e("Dataset", "p_brand"), c + "Dataset", "p_brand", ""),
        (e("CreativeWork", "'mit'"), S + "CreativeWork", "'MIT'", "WHERE p_size % 2 = 0"), (e("MLModel", "p_brand"), FAIR + "MLModel", "p_brand", ""),
    ):
        extra(subject, t, f"'{kind}'", "'uri'", "NULL", w)
        extra(subject, f"'{S}name'", name, w=w)
    extra(e("Person", "p_brand"), f"'{S}url'", f"'{hub}' || p_brand", "'uri'", "NULL", "WHERE p_size % 5 <> 0")
    extra(e("Dataset", "p_brand"), f"'{S}url'", f"'{hub}datasets/' || p_brand", "'uri'", "NULL")
    extra(e("MLModel", "p_brand"), f"'{S}url'", f"'{hub}' || p_brand", "'uri'", "NULL")
    art = e("ScholarlyArticle", "'2101.0' || CAST(p_size AS VARCHAR)")
    extra(art, t, f"'{S}ScholarlyArticle'", "'uri'", "NULL")
    extra(art, f"'{S}url'", "'https://arxiv.org/abs/2101.0' || CAST(p_size AS VARCHAR)", "'uri'", "NULL")
    return "SELECT DISTINCT s, p, o, o_kind, CAST(o_dtype AS VARCHAR) AS o_dtype FROM (" + " UNION ALL ".join(parts) + ")"


@query(_typed_sql())
def typed_objects(spark, d):
    """All object branches: terms by range, with the entity triples they bring."""
    return objects.typed_triples(part_cells(spark, d), "huggingface").select(*graph.TERM).distinct()


@query(f"""SELECT p, count(*) AS n FROM (
 SELECT '{S}name' AS p FROM documents WHERE length(text) >= 200 UNION ALL SELECT '{S}keywords' FROM documents WHERE length(text) >= 200
 UNION ALL SELECT '{RDF_TYPE}' FROM (SELECT DISTINCT lang FROM documents WHERE length(text) >= 200 AND length(lang) > 2)
 UNION ALL SELECT '{FAIR}sharedBy' FROM documents WHERE length(text) >= 200
 UNION ALL SELECT '{RDF_TYPE}' FROM (SELECT DISTINCT source FROM documents WHERE length(text) >= 200) UNION ALL SELECT '{S}name' FROM (SELECT DISTINCT source FROM documents WHERE length(text) >= 200) UNION ALL SELECT '{S}url' FROM (SELECT DISTINCT source FROM documents WHERE length(text) >= 200)
) GROUP BY p""")
def statements_by_predicate(spark, d):
    """Flagship: documents through the quality filter, cells, typed objects and first-writer statements, counted by predicate."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("k"), F.col("source").alias("pipeline_tag"), F.array("lang").alias("tags"), F.col("text").alias("card"), "source", "lang")
    kept = extract.quality_filter(docs).withColumn("title", F.concat(F.lit("doc "), "k"))
    long = extract.to_long(kept.select("k", "title", "source", "lang"), "k", {"schema.org:name": "title", "fair4ml:sharedBy": "source", "schema.org:keywords": "lang"}, "Parsed", 1.0, F.lit("2024-01-01_00-00-00"))
    cells = objects.attach_ranges(long.withColumnRenamed("time", "extraction_time"), spark.createDataFrame(RANGES[:3], "property string, real_range string, file_order int"))
    statements = graph.disambiguate(objects.typed_triples(cells, "huggingface"))
    return statements.groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT doc_id, CASE WHEN length(t) < 100 THEN 'short' ELSE 'long' END AS form, CASE WHEN length(t) < 100 THEN t ELSE 'Extracted model info: ' || substr(t, 1, 50) || '...' END AS name
FROM (SELECT doc_id, text AS t FROM documents) WHERE regexp_replace(t, '^\\s+|\\s+$', '', 'g') NOT IN ('', 'None')""")
def dataset_long_short(spark, d):
    """Short dataset texts are names, long ones become descriptions with a shortened name."""
    t = F.col("text")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("entity"), F.lit("fair4ml:trainedOn").alias("property"), t.alias("data"), F.lit("Dataset").alias("range"), F.col("doc_id").cast("string").alias("method"), F.lit(1.0).alias("confidence"), F.lit("t").alias("extraction_time"))
    rows = objects.typed_triples(docs, "huggingface")
    name, desc = rows.filter(F.col("p") == S + "name"), rows.filter(F.col("p") == S + "description").select("method").distinct().withColumn("form", F.lit("long"))
    return name.join(desc, "method", "left").select(F.col("method").cast("long").alias("doc_id"), F.coalesce("form", F.lit("short")).alias("form"), F.col("o").alias("name"))


@query(r"""SELECT page_id, CASE WHEN contains(url, '.') THEN split_part(list_extract(string_split(regexp_replace(url, '^\s+|\s+$', '', 'g'), '/'), -1), 'v', 1) END AS ident FROM pages""")
def article_ids(spark, d):
    return table(spark, d, "pages").select("page_id", article_id(F.col("url")).alias("ident"))


@query(f"""WITH m AS (SELECT 'm' || CAST(label AS VARCHAR) AS s, {uri_sql('EvaluationObject', 'CAST(label AS VARCHAR)', 'open_ml')} AS e, count(*) AS n, CAST(max(vec_id) AS DOUBLE) AS top FROM embeddings GROUP BY label)
SELECT s, '{FAIR}hasEvaluation' AS p, e AS o, CAST(NULL AS DOUBLE) AS v FROM m UNION ALL SELECT e, '{RDF_TYPE}', '{FAIR}EvaluationObject', NULL FROM m UNION ALL SELECT e, '{FAIR}count', NULL, CAST(n AS DOUBLE) FROM m UNION ALL SELECT e, '{FAIR}top', NULL, top FROM m""")
def evaluation_metrics(spark, d):
    m = table(spark, d, "embeddings").groupBy("label").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("vec_id").cast("double").alias("top"))
    rows = m.select(F.concat(F.lit("m"), F.col("label").cast("string")).alias("s"), F.col("label").cast("string").alias("ident"), F.create_map(F.lit("count"), "n", F.lit("top"), "top").alias("metrics"))
    out = objects.evaluation_triples(rows, "open_ml")
    number = F.col("o_dtype") == XSD + "double"
    return out.select("s", "p", F.when(~F.coalesce(number, F.lit(False)), F.col("o")).alias("o"), F.when(number, F.col("o").cast("double")).alias("v"))


@query(f"""WITH x AS (SELECT s_suppkey, s_name, {uri_sql('DatasetObject', 's_name', 'open_ml')} AS e FROM supplier), y AS (SELECT *, '{BASE}' || sha256('estimationProcedure' || e) AS pr FROM x)
SELECT s, p, o FROM (SELECT 'r' || CAST(s_suppkey AS VARCHAR) AS s, '{FAIR}trainedOn' AS p, e AS o FROM y UNION ALL SELECT e, '{RDF_TYPE}', '{FAIR}DatasetObject' FROM y UNION ALL SELECT e, '{S}name', s_name FROM y UNION ALL SELECT e, '{S}url', 'https://o.org/' || CAST(s_suppkey AS VARCHAR) FROM y
UNION ALL SELECT e, '{FAIR}estimationProcedure', pr FROM y UNION ALL SELECT pr, '{S}name', 'cv' FROM y UNION ALL SELECT pr, '{S}url', 'https://o.org/splits' FROM y UNION ALL SELECT pr, '{FAIR}folds', '10' FROM y)""")
def dataset_object_triples(spark, d):
    sup = table(spark, d, "supplier")
    rows = sup.select(F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("s"), F.lit(FAIR + "trainedOn").alias("p"), F.col("s_name").alias("name"), F.concat(F.lit("https://o.org/"), F.col("s_suppkey").cast("string")).alias("url"), F.struct(F.lit("cv").alias("type"), F.lit("https://o.org/splits").alias("data_splits_url"), F.create_map(F.lit("folds"), F.lit("10")).alias("parameters")).alias("procedure"))
    return objects.dataset_objects(rows, "open_ml").select("s", "p", "o")


@query(f"""WITH a AS (SELECT p_partkey, p_name, p_brand, p_type, {uri_sql('ScholarlyArticle', "'2001.' || CAST(p_partkey AS VARCHAR)", 'arxiv')} AS e, '2001.' || CAST(p_partkey AS VARCHAR) AS i FROM part)
SELECT DISTINCT * FROM (SELECT e AS s, '{RDF_TYPE}' AS p, '{S}ScholarlyArticle' AS o FROM a UNION ALL SELECT e, '{S}name', p_name FROM a UNION ALL SELECT e, '{S}url', 'https://arxiv.org/abs/' || i FROM a UNION ALL SELECT e, '{S}keywords', p_type FROM a UNION ALL SELECT e, '{S}keywords', p_brand FROM a UNION ALL SELECT e, '{S}author', p_brand FROM a UNION ALL SELECT e, '{S}datePublished', '2020-01-01' FROM a)""")
def article_triples(spark, d):
    none = F.lit(None).cast("string")
    a = table(spark, d, "part").select(F.concat(F.lit("http://arxiv.org/abs/2001."), F.col("p_partkey").cast("string"), F.lit("v3")).alias("arxiv_id"), F.col("p_name").alias("title"), none.alias("summary"), none.alias("doi"), F.lit("2020-01-01").alias("published"), F.array("p_type", "p_brand").alias("keywords"), F.array(F.struct(F.col("p_brand").alias("name"))).alias("authors"))
    return objects.article_triples(a).select("s", "p", "o")


@query(f"""WITH k AS (SELECT DISTINCT p_type, {uri_sql('DefinedTerm', 'lower(p_type)')} AS e FROM part) SELECT e AS s, '{RDF_TYPE}' AS p, '{S}DefinedTerm' AS o FROM k UNION SELECT e, '{S}name', p_type FROM k UNION SELECT e, '{S}description', 'about ' || p_type FROM k""")
def keyword_triples(spark, d):
    k = table(spark, d, "part").select(F.col("p_type").alias("tag_name"), F.concat(F.lit("about "), "p_type").alias("description")).distinct()
    return objects.keyword_triples(k).select("s", "p", "o")


@query(f"""WITH l AS (SELECT s_name, s_suppkey, {uri_sql('CreativeWork', 'lower(s_name)', 'spdx')} AS e FROM supplier) SELECT e AS s, '{RDF_TYPE}' AS p, '{S}CreativeWork' AS o FROM l UNION SELECT e, '{S}name', 'Licence ' || s_name FROM l UNION SELECT e, '{S}identifier', s_name FROM l UNION SELECT e, '{S}url', 'https://l/' || CAST(s_suppkey AS VARCHAR) FROM l""")
def licence_triples(spark, d):
    l = table(spark, d, "supplier").select(F.col("s_name").alias("Identifier"), F.concat(F.lit("Licence "), "s_name").alias("Name"), F.concat(F.lit("https://l/"), F.col("s_suppkey").cast("string")).alias("URL"), F.lit(None).cast("string").alias("Text"))
    return objects.licence_triples(l).select("s", "p", "o")


@query(f"""WITH {NATION_SQL}, m AS (SELECT '_:' || md5(concat_ws(chr(1), s, p, o, 'Parsed', '0.9', '2024')) AS node, * FROM nt)
SELECT node, '{RDF_TYPE}' AS predicate, '{BASE}meta/StatementMetadata' AS object FROM m UNION ALL SELECT node, '{BASE}meta/subject', s FROM m UNION ALL SELECT node, '{BASE}meta/predicate', p FROM m UNION ALL SELECT node, '{BASE}meta/object', o FROM m
UNION ALL SELECT node, '{BASE}meta/extractionMethod', 'Parsed' FROM m UNION ALL SELECT node, '{BASE}meta/confidence', '0.9' FROM m UNION ALL SELECT node, '{BASE}meta/extractionTime', '2024' FROM m""")
def reify_statements(spark, d):
    return graph.reify(nation_triples(spark, d).withColumns({"method": F.lit("Parsed"), "confidence": F.lit(0.9), "extraction_time": F.lit("2024")}))


@query(f"""WITH {NATION_SQL} SELECT s AS subject, p AS predicate, o AS object, 'Parsed' AS "extractionMethod", '0.9' AS confidence, '2024' AS "extractionTime" FROM nt""")
def pivot_metadata(spark, d):
    return graph.pivot_metadata(reify_statements(spark, d)).drop("node")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1""")
def first_writer(spark, d):
    return graph.first_writer(table(spark, d, "events"), ["user_id", "event_type"], [F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query(f"""WITH {CUSTOMER_SQL}, {NATION_SQL} SELECT * FROM ct UNION SELECT * FROM nt""")
def graph_union_distinct(spark, d):
    c = customer_triples(spark, d)
    return graph.union_graphs(c, nation_triples(spark, d), c)


@query("""SELECT user_id, event_type, value AS confidence, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, ts DESC, event_id) AS n FROM events) WHERE n = 1""")
def disambiguate_statements(spark, d):
    e = table(spark, d, "events").withColumnRenamed("value", "confidence")
    return graph.disambiguate(e, ["user_id", "event_type"], "confidence", "ts", ["event_id"]).select("user_id", "event_type", "confidence", "ts", "event_id")


@query(f"""WITH {CUSTOMER_SQL}, r AS (SELECT {uri_sql('Dataset', 'CAST(n_nationkey AS VARCHAR)')} AS old, 'https://n.org/' || n_name AS new FROM nation)
SELECT ct.s, p, coalesce(r.new, o) AS o, o_kind, o_dtype FROM ct LEFT JOIN r ON o = r.old AND o_kind <> 'literal'""")
def node_rename(spark, d):
    names = table(spark, d, "nation").select(entity_uri("huggingface", "Dataset", F.col("n_nationkey").cast("string")).alias("old"), F.concat(F.lit("https://n.org/"), "n_name").alias("new"))
    return graph.rename_nodes(customer_triples(spark, d), names).select(*graph.TERM)


@query(f"""WITH {CUSTOMER_SQL}, {NATION_SQL}, a AS (SELECT * FROM ct UNION SELECT * FROM nt), g AS (SELECT s FROM a WHERE p = '{RDF_TYPE}' AND o = '{NAMESPACES['cr']}Dataset')
SELECT * FROM a WHERE s NOT IN (SELECT s FROM g) AND o NOT IN (SELECT s FROM g)""")
def delete_typed_nodes(spark, d):
    return graph.delete_typed_nodes(graph_union_distinct(spark, d), [NAMESPACES["cr"] + "Dataset"])


@query(f"""WITH {NATION_SQL} SELECT * FROM nt""")
def drop_bnodes(spark, d):
    t = nation_triples(spark, d)
    blank = t.withColumn("s", F.concat(F.lit("_:"), F.md5("s")))
    to_blank = t.withColumns({"o": F.lit("_:x"), "o_kind": F.lit("bnode")})
    return graph.drop_blank_nodes(t.unionByName(blank).unionByName(to_blank)).distinct()


@query(f"""SELECT '_:' || CAST(n_nationkey AS VARCHAR) AS node, '{S}Dataset' AS type FROM nation WHERE n_nationkey % 2 = 0""")
def bnodes_with_type(spark, d):
    n = table(spark, d, "nation").filter("n_nationkey % 2 = 0")
    t = n.select(F.concat(F.lit("_:"), F.col("n_nationkey").cast("string")).alias("s"), F.lit(RDF_TYPE).alias("p"), F.lit(S + "Dataset").alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("o_dtype"))
    return graph.blank_nodes_with_type(t.unionByName(nation_triples(spark, d)))


@query(f"""WITH x AS (SELECT {uri_sql('Dataset', "'d' || CAST(s_suppkey AS VARCHAR)")} AS ds, {uri_sql('Person', "replace(s_name, ' ', '_')")} AS pe, s_name FROM supplier)
SELECT DISTINCT * FROM (SELECT ds AS s, '{RDF_TYPE}' AS p, '{S}Dataset' AS o FROM x UNION ALL SELECT ds, '{S}name', 'set ' || s_name FROM x UNION ALL SELECT ds, '{S}creator', pe FROM x UNION ALL SELECT pe, '{RDF_TYPE}', '{S}Person' FROM x UNION ALL SELECT pe, '{S}name', s_name FROM x)""")
def croissant_rewrite(spark, d):
    """Dataset descriptions in JSON-LD: files go, typed blank nodes are named, the rest of the blank nodes goes."""
    from lodeweave.sources.readers import croissant

    doc = F.to_json(F.struct(
        F.struct(F.lit(S).alias("@vocab"), F.lit(S).alias("sc"), F.lit(NAMESPACES["cr"]).alias("cr")).alias("@context"),
        F.lit("sc:Dataset").alias("@type"), F.concat(F.lit("set "), "s_name").alias("name"),
        F.struct(F.lit("sc:Person").alias("@type"), F.col("s_name").alias("name")).alias("creator"),
        F.array(F.struct(F.lit("cr:FileObject").alias("@type"), F.lit("f").alias("@id"), F.lit("file").alias("name"))).alias("distribution"),
        F.struct(F.lit("untyped").alias("name")).alias("isPartOf"),
    ))
    rec = table(spark, d, "supplier").select(F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("datasetId"), doc.alias("croissant_metadata"))
    return graph.croissant_graph(croissant(rec), "dataset_id", "huggingface").select("s", "p", "o").distinct()


@query(f"""WITH {CUSTOMER_SQL} SELECT s, p, o, o_kind, o_dtype FROM ct WHERE NOT EXISTS (SELECT 1 FROM customer q WHERE q.c_custkey % 3 = 0 AND ct.s = {uri_sql('MLModel', 'q.c_name')})""")
def graph_diff(spark, d):
    t = customer_triples(spark, d)
    gone = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(entity_uri("huggingface", "MLModel", F.col("c_name")).alias("s"))
    return graph.subtract(t, t.join(gone, "s", "left_semi"))


@query(f"""WITH {CUSTOMER_SQL} SELECT CASE WHEN p = '{S}keywords' THEN 'deprecated' ELSE 'current' END AS g, s, p, o FROM ct""")
def named_graph_move(spark, d):
    t = customer_triples(spark, d).select(F.lit("current").alias("g"), "s", "p", "o")
    return graph.move_deprecated(t, t.filter(F.col("p") == S + "keywords"), "current", "deprecated")


@query("""SELECT user_id, unnest(list(event_type ORDER BY event_id, event_type)) AS kind, unnest(list(event_id ORDER BY event_id, event_type)) AS event_id FROM events GROUP BY user_id""")
def zip_join(spark, d):
    """Arrays joined by position."""
    g = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("x"))
    z = F.arrays_zip(F.transform("x", lambda e: e["event_type"]).alias("kind"), F.transform("x", lambda e: e["event_id"]).alias("event_id"))
    return g.select("user_id", F.explode(z).alias("z")).select("user_id", "z.kind", "z.event_id")


@query(f"""WITH RECURSIVE {CUSTOMER_SQL}, k AS (SELECT s AS subject, count(*) AS n, row_number() OVER (ORDER BY s) AS i FROM ct GROUP BY s),
f AS (SELECT subject, n, i, 1::BIGINT AS chunk_id, n AS held FROM k WHERE i = 1
 UNION ALL SELECT k.subject, k.n, k.i, f.chunk_id + CAST(f.held * 7 >= 1000 AS BIGINT), k.n + CASE WHEN f.held * 7 >= 1000 THEN 0 ELSE f.held END FROM f JOIN k ON k.i = f.i + 1)
SELECT subject, n, chunk_id FROM f""")
def chunking(spark, d):
    """Whole subjects in chunks of bounded weight."""
    return graph.subject_chunks(customer_triples(spark, d), 1000)


@query(f"""WITH {CUSTOMER_SQL} SELECT s, p, list_sort(list(o)) AS objects FROM ct GROUP BY s, p""")
def entity_lookup(spark, d):
    return graph.entity_lookup(customer_triples(spark, d))


@query(f"""WITH {CUSTOMER_SQL}, {NATION_SQL}, names AS (SELECT s, o AS name FROM ct WHERE p = '{S}name' UNION ALL SELECT s, o FROM nt WHERE p = '{S}name')
SELECT ct.s, p, o, coalesce(names.name, o) AS shown FROM ct LEFT JOIN names ON o = names.s AND p = '{FAIR}trainedOn' AND o_kind <> 'literal'""")
def name_resolution(spark, d):
    t = customer_triples(spark, d)
    both = t.unionByName(nation_triples(spark, d))
    models = t.select("s").distinct()
    return graph.resolve_names(both, [FAIR + "trainedOn"]).join(models, "s", "left_semi").select("s", "p", "o", "shown")


@query(f"""WITH {CUSTOMER_SQL} SELECT s, p, o, o_kind, o_dtype FROM ct""")
def sink_roundtrip(spark, d):
    """Triples written as N-Triples and read again."""
    from lodeweave.sources.readers import ntriples
    from lodeweave.sources.writers import write_ntriples

    path = scratch_path(spark, "roundtrip")
    write_ntriples(customer_triples(spark, d), path)
    return ntriples(spark, path).select(*graph.TERM)


@query(f"""WITH {CUSTOMER_SQL} SELECT s, p, o FROM ct WHERE p = '{S}keywords' AND o = 'BUILDING'""")
def graph_pattern(spark, d):
    return graph.match(customer_triples(spark, d), p=S + "keywords", o="BUILDING").select("s", "p", "o")


@query(f"""WITH {CUSTOMER_SQL} SELECT DISTINCT s, p, o FROM ct WHERE p <> '{S}name' UNION SELECT 'urn:x', 'urn:p', 'y' """)
def named_graph_edits(spark, d):
    """Insert data, delete one triple, read the graph."""
    t = customer_triples(spark, d).filter(F.col("p") != S + "name").select(F.lit("g1").alias("g"), "s", "p", "o")
    add = spark.createDataFrame([("urn:x", "urn:p", "y"), ("urn:x", "urn:p", "z")], "s string, p string, o string")
    quads = graph.delete_triple(graph.insert_triples(t.unionByName(t.withColumn("g", F.lit("g2"))), add, "g1"), "g1", "urn:x", "urn:p", "z")
    return graph.named_graph(quads, "g1")
