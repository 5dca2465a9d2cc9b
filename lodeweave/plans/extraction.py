"""Extraction queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeweave.functions.columns import drop_first_match, epoch_day, front_matter, human_number, last_segment
from lodeweave.operators import extract, mapping
from lodeweave.plans.registry import query, table


@query("""SELECT doc_id, source, n_chars FROM documents
WHERE length(source) > 0 AND length(text) >= 200
  AND NOT ((length(text) - length(replace(text, '.', ''))) >= 38
    AND (CAST(contains(text, 'Released under') AS INT) + CAST(contains(text, 'Licensed under') AS INT) + CAST(contains(text, '|') AS INT) + CAST(contains(text, '#') AS INT)) >= 1)""")
def quality_filter(spark, d):
    """Card quality filter with stand-in phrases that occur in the documents."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "source", F.col("source").alias("pipeline_tag"), F.array("lang").alias("tags"), F.col("text").alias("card"))
    kept = extract.quality_filter(docs, phrases=("Released under", "Licensed under", "|", "#"), missing=".", gaps=38, hits=1)
    return kept.select("doc_id", "source", "n_chars")


@query("""SELECT event_id, user_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id < 100)""")
def recency_filter(spark, d):
    events = table(spark, d, "events")
    return extract.newer_than(events, "ts", events.filter("event_id < 100"), "ts").select("event_id", "user_id", "ts")


@query("""SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def keep_last_dedup(spark, d):
    out = extract.keep_last(table(spark, d, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "event_id", "event_type", "value")


@query("""SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def sort_limit(spark, d):
    return extract.page(table(spark, d, "orders"), [F.col("o_orderdate").desc(), F.col("o_orderkey")], 0, 100).select("o_orderkey", "o_orderdate")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 200""")
def offset_page(spark, d):
    rows = table(spark, d, "orders").filter("o_orderstatus = 'O'")
    return extract.page(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 200, 50).select("o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM (
  SELECT o.*, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders o WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) WHERE n = 1""")
def specific_models(spark, d):
    """Rows with given ids, the last of each."""
    ids = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    out = extract.specific(table(spark, d, "orders"), "o_custkey", ids, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return out.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT 'org/' || source || '/' || CAST(doc_id AS VARCHAR) AS entity, CAST(doc_id AS VARCHAR) AS name, source AS shared_by,
  'https://huggingface.co/org/' || source || '/' || CAST(doc_id AS VARCHAR) AS url,
  'https://huggingface.co/org/' || source || '/' || CAST(doc_id AS VARCHAR) || '/discussions' AS discussion,
  'https://huggingface.co/org/' || source || '/' || CAST(doc_id AS VARCHAR) || '/blob/main/README.md' AS readme,
  md5(text) AS description_md5 FROM documents""")
def known_fields(spark, d):
    docs = table(spark, d, "documents")
    ts = F.lit("2024-01-02 03:04:05").cast("timestamp")
    model = F.concat(F.lit("org/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    card = F.concat(F.lit("---\nlicense: mit\n---"), F.col("text"))
    raw = docs.select(model.alias("modelId"), F.col("source").alias("author"), ts.alias("createdAt"), ts.alias("last_modified"), card.alias("card"))
    out = extract.known_fields(raw)
    c = lambda n: F.col(f"`{n}`")
    return out.select("entity", c("schema.org:name").alias("name"), c("fair4ml:sharedBy").alias("shared_by"), c("schema.org:url").alias("url"), c("schema.org:discussionUrl").alias("discussion"), c("codemeta:readme").alias("readme"), F.md5(c("schema.org:description")).alias("description_md5"))


@query("""SELECT doc_id, md5(E'\\n' || text || E'\\n---\\nx: y\\n---\\n') AS body_md5, 'license: lic' || CAST(doc_id % 7 AS VARCHAR) AS front FROM documents""")
def strip_front_matter(spark, d):
    """Only the first block goes; later ones stay."""
    lic = F.concat(F.lit("license: lic"), (F.col("doc_id") % 7).cast("string"))
    card = F.concat(F.lit("---\n"), lic, F.lit("\n---\n"), F.col("text"), F.lit("\n---\nx: y\n---\n"))
    docs = table(spark, d, "documents").select("doc_id", card.alias("card"))
    return docs.select("doc_id", F.md5(drop_first_match(F.col("card"), r"(?s)---.*?---")).alias("body_md5"), F.trim(F.replace(front_matter(F.col("card")), F.lit("\n"), F.lit(""))).alias("front"))


@query("""WITH m AS (SELECT p_partkey AS entity, lower(replace(p_type, '-', ' ')) AS pipe,
    ['dataset:' || p_brand, 'arxiv:' || CAST(p_size AS VARCHAR) || '.0' || CAST(p_partkey AS VARCHAR), 'base_model:finetune:own/' || p_brand,
     CASE WHEN p_size % 2 = 0 THEN 'EN' ELSE 'fr' END, 'PyTorch', replace(p_type, ' ', '-'), 'license:mit', 'Tag' || CAST(p_size AS VARCHAR)] AS tags FROM part),
t AS (SELECT DISTINCT entity, unnest(tags) AS tag FROM m),
k AS (SELECT entity, tag, lower(tag) AS low, lower(replace(tag, '-', ' ')) AS spaced,
   lower(tag) IN ('en', 'fr') AS is_lang, lower(tag) = 'pytorch' AS is_lib, lower(replace(tag, '-', ' ')) IN (SELECT DISTINCT lower(p_type) FROM part) AS is_task FROM t)
SELECT entity,
  list_sort(list(DISTINCT replace(tag, 'dataset:', '')) FILTER (WHERE contains(tag, 'dataset:'))) AS datasets,
  list_sort(list(DISTINCT 'https://arxiv.org/abs/' || replace(tag, 'arxiv:', '')) FILTER (WHERE contains(tag, 'arxiv:'))) AS articles,
  list_sort(list(DISTINCT split_part(tag, ':', -1)) FILTER (WHERE contains(tag, 'base_model:'))) AS base_models,
  list_sort(list(DISTINCT tag) FILTER (WHERE is_lang)) AS languages,
  list_sort(list(DISTINCT low) FILTER (WHERE is_lib)) AS libraries,
  list_sort(list(DISTINCT spaced) FILTER (WHERE is_task)) AS tasks,
  list_sort(list(DISTINCT low) FILTER (WHERE NOT contains(tag, ':') AND NOT is_lang)) AS keywords
FROM k GROUP BY entity""")
def tag_classify(spark, d):
    part = table(spark, d, "part")
    text = lambda c: F.col(c).cast("string")
    tags = F.array(
        F.concat(F.lit("dataset:"), "p_brand"),
        F.concat(F.lit("arxiv:"), text("p_size"), F.lit(".0"), text("p_partkey")),
        F.concat(F.lit("base_model:finetune:own/"), "p_brand"),
        F.when(F.col("p_size") % 2 == 0, "EN").otherwise("fr"),
        F.lit("PyTorch"),
        F.replace("p_type", F.lit(" "), F.lit("-")),
        F.lit("license:mit"),
        F.concat(F.lit("Tag"), text("p_size")),
    )
    models = part.select(F.col("p_partkey").alias("entity"), tags.alias("tags"), F.col("p_type").alias("pipeline_tag"))
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "name string")
    return extract.classify_tags(models, words("en", "fr"), words("pytorch"), part.select(F.lower("p_type").alias("name")).distinct())


@query("""SELECT doc_id, 'lic' || CAST(doc_id % 5 AS VARCHAR) AS license_name, lang AS language, 'ask ' || source || E'\\nyes' AS gated FROM documents""")
def front_matter_fields(spark, d):
    """Flat keys of a card's front matter, and the text of its gate keys."""
    block = F.concat(F.lit("---\nlicense_name: lic"), (F.col("doc_id") % 5).cast("string"), F.lit("\nlanguage: "), "lang", F.lit("\nextra_gated_heading: ask "), "source", F.lit("\nextra_gated_button: yes\n---\n"), "text")
    f = table(spark, d, "documents").select("doc_id", extract.flat_yaml(front_matter(block)).alias("f"))
    return f.select("doc_id", F.col("f")["license_name"].alias("license_name"), F.col("f")["language"].alias("language"), extract.gated_info(F.col("f")).alias("gated"))


SPDX = (("MIT", "MIT License"), ("Apache-2.0", "Apache License 2.0"), ("CC-BY-NC-4.0", "Creative Commons Attribution Non Commercial 4.0 International"), ("BSD-3-Clause", "BSD 3-Clause License"))
_SPDX_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in SPDX) + ") AS spdx(identifier, name)"


@query(f"""WITH g AS (SELECT DISTINCT CASE p_size % 5 WHEN 0 THEN 'mit' WHEN 1 THEN 'Apache License 2.0' WHEN 2 THEN 'CC-BY-NC-4.0' WHEN 3 THEN 'bsd 3-clause license' ELSE 'own-' || CAST(p_size AS VARCHAR) END AS given FROM part)
SELECT given, identifier, name AS licence_name, 'https://spdx.org/licenses/' || identifier || '.html' AS url
FROM g JOIN {_SPDX_SQL} ON lower(given) = lower(identifier) OR lower(given) = lower(name)""")
def license_lookup(spark, d):
    """Licences by identifier, else by name."""
    size = F.col("p_size")
    given = F.when(size % 5 == 0, "mit").when(size % 5 == 1, "Apache License 2.0").when(size % 5 == 2, "CC-BY-NC-4.0").when(size % 5 == 3, "bsd 3-clause license").otherwise(F.concat(F.lit("own-"), size.cast("string")))
    names = table(spark, d, "part").select(given.alias("name")).distinct()
    return extract.spdx_lookup(names, spark.createDataFrame(SPDX, "identifier string, name string"))


@query(f"""WITH f AS (SELECT p_partkey AS entity, p_size, CASE p_size % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'Apache License 2.0' ELSE 'own terms' END AS given FROM part)
SELECT entity, coalesce(a.identifier, b.identifier, given || E'\\nlicense: ' || given || E'\\nlicense_link: L' || CAST(p_size AS VARCHAR)) AS licence FROM f
LEFT JOIN {_SPDX_SQL.replace('spdx(', 'a(')} ON lower(given) = lower(a.identifier) LEFT JOIN {_SPDX_SQL.replace('spdx(', 'b(')} ON lower(given) = lower(b.name)""")
def license_normalise(spark, d):
    size = F.col("p_size")
    given = F.when(size % 3 == 0, "mit").when(size % 3 == 1, "Apache License 2.0").otherwise("own terms")
    fields = F.create_map(F.lit("license"), given, F.lit("license_link"), F.concat(F.lit("L"), size.cast("string")), F.lit("other"), F.lit("x"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("entity"), fields.alias("fields"))
    return extract.licence_info(rows, spark.createDataFrame(SPDX, "identifier string, name string"))


@query("""SELECT entity, property, CAST(pos AS INT) AS pos, coalesce(data, 'Information not found') AS data, 'Parsed' AS method, CASE WHEN data IS NULL THEN 1.0 ELSE 0.9 END AS confidence, '2024-01-01' AS extraction_time FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS entity, 'schema.org:name' AS property, 0 AS pos, c_name AS data FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'schema.org:keywords', 0, c_mktsegment FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'schema.org:keywords', 1, CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'schema.org:license', 0, CASE WHEN c_acctbal > 0 THEN 'mit' END FROM customer)""")
def cell_wrap(spark, d):
    """Wide columns to the long form of extraction cells."""
    wide = table(spark, d, "customer").select("c_custkey", "c_name", F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("kw"), F.when(F.col("c_acctbal") > 0, "mit").alias("lic"))
    return extract.to_long(wide, "c_custkey", {"schema.org:name": "c_name", "schema.org:keywords": "kw", "schema.org:license": "lic"}, "Parsed", 0.9, F.lit("2024-01-01"))


@query("""SELECT c_custkey, c_name AS name, 'https://huggingface.co/' || c_name || '/x' AS link, [c_mktsegment, CAST(c_nationkey AS VARCHAR)] AS trained_on, [c_mktsegment, 'Python'] AS software, 'Information not found' AS missing FROM customer""")
def rule_mapping(spark, d):
    """A rule table compiled into one projection."""
    rules = [
        ("name", "find_value", '{"property_name": "c_name"}'),
        ("link", "build_link", '{"property_name": "c_name", "suffix": "/x"}'),
        ("trained_on", "concat_values", '{"sources": ["c_mktsegment", "c_nationkey"]}'),
        ("software", "with_constant", '{"source": "c_mktsegment", "constant": "Python"}'),
        ("missing", "not_extracted", "{}"),
    ]
    out = mapping.apply_rules(table(spark, d, "customer"), rules, ["c_custkey"])
    return out.select("c_custkey", *(F.col(c)[0]["data"].alias(c) for c in ("name", "link", "missing")), *(F.transform(c, lambda x: x["data"]).alias(c) for c in ("trained_on", "software")))


@query("""SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, 'a.type', event_type FROM events UNION ALL SELECT event_id, 'a.user.id', CAST(user_id AS VARCHAR) FROM events""")
def json_flatten(spark, d):
    """Nested documents to dotted leaves."""
    doc = F.concat(F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "a": {"type": "'), "event_type", F.lit('", "user": {"id": '), F.col("user_id").cast("string"), F.lit("}}}"))
    return mapping.flatten_json(table(spark, d, "events").select("event_id", doc.alias("doc")), "event_id", "doc")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS first_of, '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS both_of, CAST(NULL AS VARCHAR) AS none_of FROM events""")
def path_mapping(spark, d):
    """Mapping keys to the values found at their paths: one, several, or none."""
    doc = F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), F.struct("event_type", F.col("user_id").cast("string").alias("user")).alias("a")))
    rows = table(spark, d, "events").select("event_id", doc.alias("doc"))
    cols = mapping.map_record(F.col("doc"), {"k": ["k"], "first_of": ["missing", "a.event_type"], "both_of": ["a.event_type", "a.user"], "none_of": ["b.c"]})
    return rows.select("event_id", *cols).withColumn("k", F.col("k").cast("long"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 1000 AS BIGINT) WHEN 1 THEN CAST((o_orderkey % 100) * 1000 + 500 AS BIGINT) WHEN 2 THEN CAST((o_orderkey % 50) * 1000000 AS BIGINT) ELSE 0 END AS n FROM orders""")
def human_number_parse(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, (k % 1000).cast("string")).when(k % 4 == 1, F.concat((k % 100).cast("string"), F.lit(".5K"))).when(k % 4 == 2, F.concat((k % 50).cast("string"), F.lit("M likes"))).otherwise("none")
    return table(spark, d, "orders").select("o_orderkey", human_number(text).alias("n"))


@query("""SELECT page_id, CAST(coalesce(TRY_CAST(nullif(regexp_extract(html, '<h1[^>]*>[^0-9<]*([0-9]+)', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(html, '([0-9]+) ?(?:likes|views|pages)', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(html, '([0-9]+)', 1), '') AS BIGINT), 0) AS BIGINT) AS first_number,
  CAST(coalesce(TRY_CAST(nullif(regexp_extract(html, 'downloads: ([0-9]+)', 1), '') AS BIGINT), 0) AS BIGINT) AS downloads, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""")
def html_stat_scrape(spark, d):
    """Numbers from page texts with fallback patterns."""
    pages = table(spark, d, "pages").select("page_id", "html", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return mapping.scrape_stats(pages, {"first_number": ["<h1[^>]*>[^0-9<]*([0-9]+)", "([0-9]+) ?(?:likes|views|pages)", "([0-9]+)"], "downloads": ["downloads: ([0-9]+)"]})


@query("""SELECT l_orderkey, l_linenumber, o_orderdate, p_brand, s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def four_way_lookup(spark, d):
    """Run, dataset, flow and task look-ups."""
    runs = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("dataset_id"), F.col("l_partkey").alias("flow_id"), F.col("l_suppkey").alias("task_id"))
    out = mapping.run_metadata(
        runs,
        table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate"),
        table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand"),
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_name"),
    )
    return out.select("l_orderkey", "l_linenumber", "o_orderdate", "p_brand", "s_name")


@query("""SELECT c_custkey, coalesce(s.s_name, 'unknown') AS status FROM customer LEFT JOIN supplier s ON c_custkey = s_suppkey""")
def status_coalesce(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("status"))
    out = mapping.coalesce_status(ids, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("status")))
    return out.select(F.col("id").alias("c_custkey"), "status")


@query("""SELECT event_id, strftime(make_timestamp((1600000000 + event_id * 86400) * 1000000), '%Y-%m-%d') AS day FROM events""")
def epoch_to_date(spark, d):
    return table(spark, d, "events").select("event_id", epoch_day(F.lit(1600000000) + F.col("event_id") * 86400).alias("day"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://orcid.org/' || CAST(c_nationkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN 'https://github.com/' || c_name ELSE '' END AS url,
  c_name || CASE WHEN c_custkey % 3 = 0 THEN ' (10.1/' || CAST(c_nationkey AS VARCHAR) || ')' WHEN c_custkey % 3 = 1 THEN ' (u' || c_name || ')' ELSE '' END || '; second' AS cited FROM customer""")
def author_links(spark, d):
    """Author pages by preference, and citation texts."""
    k = F.col("c_custkey") % 3
    orcid, user = F.when(k == 0, F.col("c_nationkey").cast("string")), F.when(k == 1, F.col("c_name"))
    authors = F.array(F.struct(F.col("c_name").alias("name"), orcid.alias("orcid"), user.alias("github_user")))
    none = F.lit(None).cast("string")
    cites = F.array(F.struct(F.col("c_name").alias("text"), F.concat(F.lit("10.1/"), orcid).alias("doi"), F.concat(F.lit("u"), user).alias("url")), F.struct(F.lit("second").alias("text"), none.alias("doi"), none.alias("url")))
    return table(spark, d, "customer").select("c_custkey", mapping.author_entries(authors)[0]["url"].alias("url"), mapping.citation(cites).alias("cited"))


@query("""SELECT DISTINCT 'keyword' AS kind, c_mktsegment AS name FROM customer UNION SELECT DISTINCT 'dataset', n_name FROM nation UNION SELECT DISTINCT 'dataset', r_name FROM region""")
def related_names(spark, d):
    cells = lambda t, col, prop: extract.to_long(table(spark, d, t).select(F.lit("e").alias("k"), col), "k", {prop: col}, "m", 1.0, F.lit("t"))
    long = cells("customer", "c_mktsegment", "schema.org:keywords").unionByName(cells("nation", "n_name", "fair4ml:trainedOn")).unionByName(cells("region", "r_name", "fair4ml:testedOn"))
    return extract.related_names(long, {"keyword": ["schema.org:keywords"], "dataset": ["fair4ml:trainedOn", "fair4ml:testedOn"]})


@query("""WITH RECURSIVE e AS (SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS src, 'n' || CAST(n_nationkey AS VARCHAR) AS dst FROM nation
  UNION ALL SELECT 'n' || CAST(c_nationkey AS VARCHAR), 'c' || CAST(c_custkey AS VARCHAR) FROM customer UNION ALL SELECT 'n' || CAST(s_nationkey AS VARCHAR), 's' || CAST(s_suppkey AS VARCHAR) FROM supplier),
x AS (SELECT 'r1' AS id, 0 AS depth UNION ALL SELECT dst, depth + 1 FROM x JOIN e ON src = id WHERE depth < 2)
SELECT id, CAST(min(depth) AS INT) AS depth FROM x GROUP BY id""")
def depth_expand(spark, d):
    """What a region reaches in two steps."""
    pair = lambda t, sp, s, dp, c: table(spark, d, t).select(F.concat(F.lit(sp), F.col(s).cast("string")).alias("src"), F.concat(F.lit(dp), F.col(c).cast("string")).alias("dst"))
    edges = pair("nation", "r", "n_regionkey", "n", "n_nationkey").unionByName(pair("customer", "n", "c_nationkey", "c", "c_custkey")).unionByName(pair("supplier", "n", "s_nationkey", "s", "s_suppkey"))
    return extract.expand(spark.range(1).select(F.lit("r1").alias("id")), edges, 2)


@query("""SELECT CASE WHEN lower(trim(p_type)) IN ('small', 'large', 'economy') THEN lower(trim(p_type)) ELSE 'unknown' END AS kind, count(*) AS n FROM part GROUP BY 1""")
def group_by_type(spark, d):
    return mapping.group_by_type(table(spark, d, "part"), ("small", "large", "economy"), "p_type").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey AS dataset_id, p_name AS name, 'distribution' AS part, p_brand AS part_name FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, p_name, 'record_set', p_type FROM part WHERE p_size % 3 = 1
UNION ALL SELECT p_partkey, p_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM part WHERE p_size % 3 = 0""")
def croissant_wide_rows(spark, d):
    one = lambda cond, c: F.when(cond, F.array(F.struct(F.col(c).alias("name"))))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("dataset_id"), F.col("p_name").alias("name"), one(F.col("p_size") % 3 != 0, "p_brand").alias("distribution"), one(F.col("p_size") % 3 == 1, "p_type").alias("record_set"))
    return mapping.croissant_rows(rows)


@query("""SELECT DISTINCT list_extract(string_split(p_name, ' '), -1) AS name FROM part""")
def model_name_list(spark, d):
    """Last segments of names, as lists of models are read."""
    return table(spark, d, "part").select(last_segment(F.replace("p_name", F.lit(" "), F.lit("/"))).alias("name")).distinct()


@query("""SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05' AND event_id % 3 <> 0 ORDER BY ts DESC, event_id LIMIT 40""")
def recent_descriptions(spark, d):
    e = table(spark, d, "events").withColumn("doc", F.when(F.col("event_id") % 3 == 0, "{ }").otherwise(F.col("props")))
    return extract.recent_descriptions(e, F.lit("2024-01-05").cast("timestamp_ntz"), 40, "doc", "ts", "event_id").select("event_id", "ts")


@query("""SELECT doc_id, md5(E'\\n' || text || CASE WHEN doc_id % 2 = 0 THEN '---end' ELSE '' END) AS rest FROM documents""")
def context_after_front_matter(spark, d):
    card = F.concat(F.lit("---\na: b\n---\n"), "text", F.when(F.col("doc_id") % 2 == 0, "---end").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.md5(extract.after_front_matter(card)).alias("rest"))


@query("""SELECT user_id, list(coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END, '') ORDER BY event_id) AS vals FROM events GROUP BY user_id""")
def flat_cell_values(spark, d):
    cell = F.struct("event_id", F.when(F.col("event_id") % 5 != 0, F.array("event_type")).alias("data"))
    g = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return g.select("user_id", extract.flat_values(F.col("cells")).alias("vals"))


@query("""SELECT 'm' || CAST(p_partkey AS VARCHAR) AS "modelId", [lower(p_type)] AS q3, [p_brand] AS q4, ['en', 'en'] AS q13, [p_type, 'en', 'en', 'PyTorch'] AS q16, ['PyTorch'] AS q17 FROM part""")
def question_columns(spark, d):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    ts = F.lit("2024-01-02").cast("timestamp")
    tags = F.array("p_type", F.concat(F.lit("dataset:"), "p_brand"), F.lit("en"), F.lit("en"), F.lit("PyTorch"), F.lit("region:us"))
    part = table(spark, d, "part")
    models = part.select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("modelId"), F.col("p_brand").alias("author"), ts.alias("createdAt"), F.lit(5).cast("long").alias("downloads"), tags.alias("tags"))
    out = extract.question_columns(models, part.select(F.lower("p_type").alias("name")).distinct(), names("en"), names("pytorch"), F.lit("t"))
    return out.select("modelId", *(F.col(f"q_id_{i}")[0]["data"].alias(f"q{i}") for i in (3, 4, 13, 16, 17)))
