"""Text queries: sections, chunks, similarity, questions and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.operators import markdown, matching
from lodeweave.plans.registry import query, table


def _cards(spark, d):
    """Documents as Markdown: a header per third line, a table and a list."""
    lines = F.split("text", "\n")
    marked = F.transform(lines, lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("# Part "), i.cast("string"), F.lit("\n"), x)).when(i % 3 == 1, F.concat(F.lit("- "), x, F.lit("\n- second"))).otherwise(x))
    return table(spark, d, "documents").select("doc_id", F.array_join(marked, "\n").alias("card"))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents), g AS (SELECT doc_id, a, CAST(len(a) AS INT) AS n, CAST(unnest(range(0, (len(a) + 2) // 3)) AS INT) AS pos FROM l)
SELECT doc_id, pos, 'Part ' || CAST(3 * pos AS VARCHAR) AS title,
  'Part ' || CAST(3 * pos AS VARCHAR) || ':' || chr(10) || list_aggregate(list_filter([a[3 * pos + 1], '- ' || a[3 * pos + 2], CASE WHEN 3 * pos + 2 <= n THEN '- second' END, a[3 * pos + 3]], lambda x: x IS NOT NULL AND trim(x) <> ''), 'string_agg', chr(10)) AS content,
  5 * pos AS start_idx, CASE WHEN 3 * pos + 3 < n THEN 5 * (pos + 1) ELSE 5 * pos + CASE n - 3 * pos WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END END AS end_idx
FROM g WHERE trim(a[3 * pos + 1]) <> '' OR 3 * pos + 2 <= n""")
def md_sections(spark, d):
    """Sections under headers; the texts have no headers, fences or blank lines of their own."""
    return markdown.explode_sections(_cards(spark, d), "doc_id", "card", "headers")


@query()
def md_blocks(spark, d):
    return markdown.explode_sections(_cards(spark, d), "doc_id", "card", "fine")


@query()
def md_hierarchical(spark, d):
    return markdown.explode_sections(_cards(spark, d), "doc_id", "card", "hierarchical")


@query()
def md_trimmed_chunks(spark, d):
    return markdown.explode_sections(_cards(spark, d), "doc_id", "card", "chunks")


@query("""SELECT doc_id, 'Chunk ' || CAST(i + 1 AS VARCHAR) AS title, substr(text, CAST(i * 500 + 1 AS BIGINT), 500) AS content, CAST(i * 500 AS INT) AS start_idx FROM documents, (SELECT unnest(range(0, 2000)) AS i) WHERE i * 500 < length(text)""")
def md_chunks(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(markdown.fixed_chunks(F.col("text"), 500)).alias("c")).select("doc_id", "c.title", "c.content", "c.start_idx")


@query("""SELECT digest, doc_id, source, copies FROM (SELECT sha256(text) AS digest, doc_id, source, count(*) OVER (PARTITION BY sha256(text)) AS copies, row_number() OVER (PARTITION BY sha256(text) ORDER BY length(source), doc_id) AS n FROM documents) WHERE n = 1""")
def section_dedup(spark, d):
    return markdown.dedup_by_content(table(spark, d, "documents"), "text", "source", ["doc_id"])


_SIM = """round(CASE WHEN q.n * i.n = 0 THEN 0 ELSE list_dot_product(q.v, i.v) / (q.n * i.n) END, 6)"""
_VEC = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings)"""


@query(f"""WITH {_VEC}, s AS (SELECT q.vec_id AS question, i.vec_id, {_SIM} AS score FROM v q, v i WHERE q.vec_id % 20 = 0)
SELECT question, vec_id, score, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY question ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5""")
def cosine_topk(spark, d):
    """Every vector whose id is divisible by 20 against all vectors."""
    e = table(spark, d, "embeddings")
    q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("question"), F.col("embedding").alias("qv"))
    return matching.top_k(q, e, 5, "question", "qv", "vec_id", "embedding")


@query(f"""WITH {_VEC}, q AS (SELECT * FROM v WHERE vec_id % 20 = 0), s AS (SELECT q.label, q.vec_id AS question, i.vec_id, {_SIM} AS confidence FROM q JOIN v i ON q.label = i.label AND i.vec_id <> q.vec_id)
SELECT label, question, vec_id, confidence, 'DirectContextMatch_SectionContent' AS method FROM (SELECT *, row_number() OVER (PARTITION BY label, question ORDER BY confidence DESC, vec_id) AS r FROM s) WHERE r = 1""")
def context_match(spark, d):
    """Best other vector of the same label for every vector whose id is divisible by 20."""
    e = table(spark, d, "embeddings")
    q = e.filter("vec_id % 20 = 0").select("label", F.col("vec_id").alias("question"), F.col("embedding").alias("qv"))
    return matching.context_match(q, e, q_id="question", q_vec="qv", i_id="vec_id", i_vec="embedding", within=["label"], but_itself=True)


@query("""SELECT conv_id, turn, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // 5 AS BIGINT) AS batch FROM conversations""")
def qa_group_batches(spark, d):
    rows = table(spark, d, "conversations")
    return matching.batch_by_context(rows, "conv_id", [F.col("turn"), F.col("role"), F.col("text")], 5).select("conv_id", "turn", "batch")


@query("""SELECT p_partkey, p_name AS a1, p_brand AS a2, '' AS a3 FROM part""")
def multi_answer_parse(spark, d):
    response = F.concat(F.lit("1. "), "p_name", F.lit("\nAnswer 2: "), "p_brand", F.lit("\nthanks"))
    a = matching.answers(response, 3)
    return table(spark, d, "part").select("p_partkey", a[0].alias("a1"), a[1].alias("a2"), a[2].alias("a3"))


@query(f"""WITH {_VEC}, q AS (SELECT * FROM v WHERE vec_id % 20 = 0), s AS (SELECT q.vec_id AS question, {_SIM} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_SIM} DESC, i.vec_id) AS r FROM q, v i)
SELECT question, round(avg(score), 6) AS mean_score FROM s WHERE r <= 5 GROUP BY question""")
def mean_match_score(spark, d):
    return matching.mean_score(cosine_topk(spark, d), ["question"]).withColumn("mean_score", F.round("mean_score", 6))


@query()
def schema_properties(spark, d):
    """Properties of every document by context matching of its sections."""
    rows = markdown.explode_sections(_cards(spark, d), "doc_id", "card", "headers").select("doc_id", "pos", "content")
    asks = spark.createDataFrame([("schema.org:license", "under what license is it released"), ("fair4ml:intendedUse", "what is it for")], "property string, question string")
    return matching.extract_properties(rows, asks, "context_matching")
