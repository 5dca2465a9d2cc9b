"""Search queries: documents from triples, upsert, analyzers, query predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.functions.vocab import NAMESPACES
from lodeweave.operators import search as ops
from lodeweave.plans.graphs import CUSTOMER_SQL, NATION_SQL, customer_triples, nation_triples
from lodeweave.plans.registry import query, table

S, FAIR = NAMESPACES["schema"], NAMESPACES["fair4ml"]


@query(f"""WITH {CUSTOMER_SQL}, {NATION_SQL} SELECT c.s AS db_identifier, c_name AS name, [c_mktsegment] AS keywords, [n_name] AS datasets, 'unknown' AS platform FROM c JOIN n ON nation = n.s""")
def search_documents(spark, d):
    docs = ops.documents(customer_triples(spark, d).unionByName(nation_triples(spark, d)))
    return docs.select("db_identifier", "name", "keywords", F.col("relatedDatasets").alias("datasets"), "platform")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'new ' || c_name ELSE c_name END AS name FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, 'new ' || c_name FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 4 = 0""")
def index_upsert(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = c.filter("id % 4 = 0").withColumn("name", F.concat(F.lit("new "), "name"))
    return ops.upsert(c.filter("id % 5 <> 0"), new, "id")


@query("""SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 7 <> 0""")
def index_delete(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return ops.delete(c, c.filter("id % 7 = 0"), "id")


@query("""SELECT p_partkey, list_transform(range(3, least(30, length(p_name)) + 1), lambda n: substr(lower(p_name), 1, n)) AS grams FROM part""")
def edge_ngrams(spark, d):
    return table(spark, d, "part").select("p_partkey", ops.edge_ngrams(F.col("p_name")).alias("grams"))


@query("""SELECT p_partkey, list_transform(range(1, length(p_type) - 1), lambda i: substr(lower(p_type), i, 3)) AS grams FROM part""")
def type_ngrams(spark, d):
    return table(spark, d, "part").select("p_partkey", ops.ngrams(F.col("p_type")).alias("grams"))


@query("""SELECT doc_id FROM documents WHERE list_has_any(string_split_regex(lower(text), '[^a-z0-9]+'), ['license', 'version'])""")
def match_tokens(spark, d):
    return table(spark, d, "documents").filter(ops.match(F.col("text"), "License version")).select("doc_id")


@query("""SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|[^a-z0-9])apache[^a-z0-9]+license([^a-z0-9]|$)')""")
def phrase_match(spark, d):
    return table(spark, d, "documents").filter(ops.match_phrase(F.col("text"), "Apache License")).select("doc_id")


@query("""SELECT p_partkey, p_size FROM part WHERE p_brand = 'Brand#11' OR (p_size > 10 AND p_size <= 20 AND p_type <> 'SMALL')""")
def term_range(spark, d):
    exact = ops.term(F.col("p_brand"), "Brand#11")
    span = ops.bool_query(must=[ops.in_range(F.col("p_size"), gt=10, lte=20)], must_not=[ops.term(F.col("p_type"), "SMALL")])
    return table(spark, d, "part").filter(ops.bool_query(should=[exact, span])).select("p_partkey", "p_size")


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 200000""")
def nested_query(spark, d):
    inner = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderstatus", "o_totalprice")).alias("orders"))
    hit = ops.nested(F.col("orders"), lambda o: ops.term(o["o_orderstatus"], "F") & ops.in_range(o["o_totalprice"], gte=200000))
    return inner.filter(hit).select("o_custkey")


@query("""SELECT page_id, CASE WHEN contains(lower(url), 'huggingface') THEN 'Hugging Face' WHEN contains(lower(url), 'openml') THEN 'OpenML' WHEN contains(lower(url), 'bioimage') OR contains(lower(url), 'ai4life') THEN 'AI4Life' ELSE 'unknown' END AS platform FROM pages""")
def platform_detection(spark, d):
    return table(spark, d, "pages").select("page_id", ops.platform_of("url").alias("platform"))
