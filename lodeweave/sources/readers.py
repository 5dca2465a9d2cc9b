"""Readers: tables, lists, N-Triples, Turtle, JSON-LD descriptions, platform dumps."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.functions.columns import article_id, last_segment, strip
from lodeweave.functions.vocab import NAMESPACES, RDF_TYPE

TRIPLES = "s string, p string, o string, o_kind string, o_dtype string, o_lang string"
MODEL = "modelId string, author string, last_modified timestamp, downloads long, likes long, library_name string, tags array<string>, pipeline_tag string, createdAt timestamp, card string"


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated table with a header."""
    return spark.read.csv(path, sep="\t", header=True, quote="")


def tsv_list(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """First column of a table as ``name``."""
    df = tsv(spark, path)
    name = F.col(f"`{df.columns[0]}`")
    return df.select((F.lower(name) if lower else name).alias("name"))


def model_list(spark: SparkSession, path: str) -> DataFrame:
    """Model names of a text file: blank lines and comments skipped, the last path segment kept."""
    line = strip(F.col("value"))
    return spark.read.text(path).filter((line != "") & ~line.startswith("#")).select(last_segment(line).alias("name"))


def model_cards(spark: SparkSession, path: str) -> DataFrame:
    """Model-card dump."""
    return spark.read.schema(MODEL).parquet(path)


def json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON array of records (or lines)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path)


def cells_json(spark: SparkSession, path: str, key: str = "schema.org:name") -> DataFrame:
    """Frames whose columns are lists of extraction cells, in the long form (entity, property, pos, data, method, confidence, time).

    A cell's data is a text or a list; both become rows.  Read as VARIANT, so columns may differ between records.
    """
    raw = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    raw.createOrReplaceTempView("lodeweave_raw")  # a file that holds an array comes as one value
    each = spark.sql("SELECT e.value AS v FROM lodeweave_raw, LATERAL variant_explode(v) e WHERE schema_of_variant(v) LIKE 'ARRAY%' UNION ALL SELECT v FROM lodeweave_raw WHERE schema_of_variant(v) NOT LIKE 'ARRAY%'")
    fields = each.select(F.col("v").alias("row"), F.expr(f"CAST(variant_get(v, '$[\"{key}\"][0].data') AS STRING)").alias("entity"))
    fields.createOrReplaceTempView("lodeweave_cells")
    return spark.sql(
        """
        SELECT entity, f.key AS property, CAST(coalesce(d.pos, 0) AS INT) AS pos,
               CASE WHEN d.value IS NOT NULL THEN CAST(d.value AS STRING) ELSE variant_get(c.value, '$.data', 'string') END AS data,
               variant_get(c.value, '$.extraction_method', 'string') AS method, variant_get(c.value, '$.confidence', 'double') AS confidence,
               variant_get(c.value, '$.extraction_time', 'string') AS time
        FROM lodeweave_cells, LATERAL variant_explode(row) f, LATERAL variant_explode(f.value) c
        LEFT JOIN LATERAL (SELECT * FROM variant_explode_outer(CASE WHEN schema_of_variant(variant_get(c.value, '$.data')) LIKE 'ARRAY%' THEN variant_get(c.value, '$.data') END)) d"""
    )


_NT = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|(_:[^\s.]+)|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*\.\s*$'


def _unescape(c: Column) -> Column:
    mark = F.lit("\u0001")
    out = F.replace(c, F.lit("\\\\"), mark)
    for text, raw in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
        out = F.replace(out, F.lit(text), F.lit(raw))
    return F.replace(out, mark, F.lit("\\"))


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples by line; comments and lines that are no triple are skipped."""
    g = lambda i: F.nullif(F.regexp_extract("value", _NT, i), F.lit(""))
    rows = spark.read.text(path).filter(F.col("value").rlike(_NT))
    literal = F.regexp_extract("value", _NT, 6)
    kind = F.when(g(4).isNotNull(), "uri").when(g(5).isNotNull(), "bnode").otherwise("literal")
    return rows.select(F.coalesce(g(1), g(2)).alias("s"), g(3).alias("p"), F.coalesce(g(4), g(5), _unescape(literal)).alias("o"), kind.alias("o_kind"), g(7).alias("o_dtype"), g(8).alias("o_lang"))


_TOKEN = re.compile(
    r"""\s*(?:\#[^\n]*\n|(?P<iri><[^>]*>)|(?P<long>\"\"\"(?:[^\"\\]|\\.|\"(?!\"\"))*\"\"\")|(?P<str>"(?:[^"\\\n]|\\.)*")
    |(?P<lang>@(?!prefix|base)[A-Za-z][\w-]*)|(?P<word>@prefix|@base|PREFIX|BASE)|(?P<dt>\^\^)|(?P<num>[+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w:]))
    |(?P<bn>_:[\w.-]*\w)|(?P<pn>[A-Za-z_][\w.-]*:(?:[\w%.-]*[\w%-])?|:[\w%-]*)|(?P<kw>a\b|true\b|false\b)|(?P<p>[.;,\[\]()]))""",
    re.X,
)


def parse_turtle(text: str, base: str = "") -> list[tuple]:
    """Turtle to (s, p, o, o_kind, o_dtype, o_lang): prefixes, base, predicate and object lists, blank nodes with nested properties, all literal forms."""
    prefixes: dict[str, str] = {}
    out: list[tuple] = []
    fresh = 0
    tokens: list[tuple[str, str]] = []
    at = 0
    text = text.strip() + "\n"
    while at < len(text) and text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"bad Turtle at {text[at : at + 40]!r}")
        at = m.end()
        if m.lastgroup:
            tokens.append((m.lastgroup, m[m.lastgroup]))
    i = 0
    xsd = NAMESPACES["xsd"]

    def plain(raw: str) -> str:
        return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}.get(m[1], m[1]), raw, flags=re.S)

    def name(kind: str, value: str) -> str:
        if kind == "iri":
            return value[1:-1] if re.match(r"<[A-Za-z][\w+.-]*:", value) else base + value[1:-1]
        head, _, tail = value.partition(":")
        return prefixes[head] + tail

    def node() -> tuple[str, str, str | None, str | None]:
        nonlocal i, fresh
        kind, value = tokens[i]
        i += 1
        if kind in ("iri", "pn"):
            return name(kind, value), "uri", None, None
        if kind == "bn":
            return value, "bnode", None, None
        if value == "[":
            fresh += 1
            me = f"_:b{fresh}"
            if tokens[i][1] != "]":
                pairs(me)
            i += 1
            return me, "bnode", None, None
        if kind in ("str", "long"):
            body = plain(value[3:-3] if kind == "long" else value[1:-1])
            if i < len(tokens) and tokens[i][0] == "lang":
                i += 1
                return body, "literal", None, tokens[i - 1][1][1:]
            if i < len(tokens) and tokens[i][0] == "dt":
                i += 2
                return body, "literal", name(*tokens[i - 1]), None
            return body, "literal", None, None
        if kind == "num":
            return value, "literal", xsd + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"), None
        if value in ("true", "false"):
            return value, "literal", xsd + "boolean", None
        raise ValueError(f"unexpected {value!r}")

    def pairs(subject: str) -> None:
        nonlocal i
        while True:
            kind, value = tokens[i]
            i += 1
            predicate = RDF_TYPE if (kind, value) == ("kw", "a") else name(kind, value)
            while True:
                o = node()
                out.append((subject, predicate, *o))
                if i < len(tokens) and tokens[i][1] == ",":
                    i += 1
                    continue
                break
            while i < len(tokens) and tokens[i][1] == ";":
                i += 1
            if i >= len(tokens) or tokens[i][1] in (".", "]"):
                return

    while i < len(tokens):
        kind, value = tokens[i]
        if kind == "word":
            if "prefix" in value.lower():
                prefixes[tokens[i + 1][1].rstrip(":")] = tokens[i + 2][1][1:-1]
                i += 3
            else:
                base = tokens[i + 1][1][1:-1]
                i += 2
        else:
            subject = node()
            if tokens[i][1] != ".":
                pairs(subject[0])
        if i < len(tokens) and tokens[i][1] == ".":
            i += 1
    return out


def turtle(spark: SparkSession, path: str) -> DataFrame:
    """Turtle files, each parsed whole in one task (a document of that format cannot be split)."""

    def run(parts):
        import pandas as pd

        for part in parts:
            for name_, raw in zip(part["path"], part["content"]):
                rows = parse_turtle(bytes(raw).decode("utf-8"))
                tag = hashlib.md5(name_.encode()).hexdigest()[:12]
                # blank nodes of different files stay apart
                rows = [tuple(f"_:{tag}{x[2:]}" if isinstance(x, str) and x.startswith("_:") and k in (0, 2) and (k == 0 or r[3] == "bnode") else x for k, x in enumerate(r)) for r in rows]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in TRIPLES.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, TRIPLES)


def jsonld_triples(doc: dict, base: str = "") -> list[tuple]:
    """Croissant JSON-LD to triples: the terms of its context, nested nodes, types, lists.  Nodes without @id are blank."""
    out: list[tuple] = []
    fresh = 0
    context = doc.get("@context", {}) if isinstance(doc.get("@context"), dict) else {}
    vocab = context.get("@vocab", NAMESPACES["schema"])
    spaces = {k: v for k, v in context.items() if isinstance(v, str) and v.startswith("http")} | {"sc": NAMESPACES["schema"], "cr": NAMESPACES["cr"]}

    def iri(term: str) -> str:
        given = context.get(term)
        term = (given.get("@id", term) if isinstance(given, dict) else given) if given else term
        head, colon, tail = term.partition(":")
        if colon and head in spaces:
            return spaces[head] + tail
        return term if colon else vocab + term

    def visit(node: dict) -> str:
        nonlocal fresh
        if "@id" in node:
            me = node["@id"] if ":" in node["@id"] else base + node["@id"]
        else:
            fresh += 1
            me = f"_:n{fresh}"
        types = node.get("@type", [])
        for t in [types] if isinstance(types, str) else types:
            out.append((me, RDF_TYPE, iri(t), "uri", None, None))
        for key, value in node.items():
            if key.startswith("@"):
                continue
            linked = isinstance(context.get(key), dict) and context[key].get("@type") in ("@id", "@vocab")
            for v in value if isinstance(value, list) else [value]:
                if isinstance(v, dict) and "@value" not in v:
                    o = visit(v)
                    out.append((me, iri(key), o, "bnode" if o.startswith("_:") else "uri", None, None))
                elif v is not None:
                    text = v["@value"] if isinstance(v, dict) else v
                    text = str(text).lower() if isinstance(text, bool) else str(text)
                    out.append((me, iri(key), iri(text) if linked else text, "uri" if linked else "literal", None, None))
        return me

    visit(doc)
    return out


def croissant(records: DataFrame, ident: str = "datasetId", doc: str = "croissant_metadata") -> DataFrame:
    """(id, JSON-LD text) to triples with the dataset's id; blank nodes carry the id, so descriptions stay apart.  Texts that are no objects give nothing."""

    def run(parts):
        import pandas as pd

        for part in parts:
            rows = []
            for d, text in zip(part["id"], part["doc"]):
                try:
                    got = json.loads(text) if text else None
                except ValueError:
                    got = None
                if isinstance(got, dict) and got:
                    mark = lambda x: f"_:{d}/{x[2:]}"
                    rows += [(d, mark(s) if s.startswith("_:") else s, p, mark(o) if k == "bnode" else o, k, t, lang) for s, p, o, k, t, lang in jsonld_triples(got)]
            yield pd.DataFrame(rows, columns=["dataset_id", *(c.split()[0] for c in TRIPLES.split(", "))])

    return records.select(F.col(ident).alias("id"), F.col(doc).alias("doc")).mapInPandas(run, f"dataset_id string, {TRIPLES}")


def articles(records: DataFrame, ids: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """arXiv records with the given ids (normalised on both sides; ids without a dot are ignored)."""
    wanted = ids.select(article_id(F.col(ids.columns[0])).alias("_id")).dropna().distinct()
    return records.withColumn("_id", article_id(F.col(key))).join(wanted, "_id", "left_semi").drop("_id")


def keywords(*tables: DataFrame) -> DataFrame:
    """Keyword dictionary: the tables one below the other."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def schema_properties(spark: SparkSession, path: str) -> DataFrame:
    """Schema definition table (tab- or comma-separated) as property, source, range, real_range, description, section, file_order.

    The text ``None`` as a range means that there is none.
    """
    raw = spark.read.csv(path, sep="\t" if path.endswith(".tsv") else ",", header=True)
    has = lambda c: F.trim(F.col(f"`{c}`")) if c in raw.columns else F.lit(None).cast("string")
    rng = lambda c: F.nullif(has(c), F.lit("None"))
    return raw.select(has("Property").alias("property"), has("Source").alias("source"), rng("Range").alias("range"), rng("Real_Range").alias("real_range"), has("Description").alias("description"), has("HF_Readme_Section").alias("section"), F.monotonically_increasing_id().alias("file_order"))


def path_mapping(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Mapping table (key, path) to ordered path lists; a configuration of a few dozen lines."""
    out: dict[str, list[str]] = {}
    for r in tsv(spark, path).collect():
        out.setdefault(r[0], []).append(r[1])
    return out


def path_schema(path: str) -> dict:
    """Path mapping of a platform as a JSON file (texts, mappings, lists); a missing file is a FileNotFoundError, an empty one a ValueError."""
    with open(path, encoding="utf-8") as f:
        got = json.load(f)
    if not got:
        raise ValueError(f"no paths in {path}")
    return got


#: Types of SPARQL result values by their XML schema type; everything else is text.
SPARQL_TYPES = {"integer": "bigint", "int": "bigint", "long": "bigint", "decimal": "double", "double": "double", "float": "double", "boolean": "boolean", "dateTime": "timestamp_ntz", "date": "date"}


def sparql_frame(results: DataFrame, names: list[str], col: str = "value") -> DataFrame:
    """SPARQL JSON results (one document a row) to a frame with typed columns: a column has a type if all its values state that one, else it is text."""
    cell = "struct<type:string,datatype:string,value:string>"
    got = results.select(F.explode(F.from_json(col, f"struct<results:struct<bindings:array<map<string,{cell}>>>>")["results"]["bindings"]).alias("b"))
    kind = lambda n: F.collect_set(F.coalesce(F.regexp_extract(F.col("b")[n]["datatype"], r"([^/#]+)$", 1), F.when(F.col("b")[n].isNotNull(), F.lit("text")))).alias(n)
    kinds = got.agg(*map(kind, names)).first()
    typed = lambda n: SPARQL_TYPES.get(kinds[n][0], "string") if len(kinds[n]) == 1 else "string"
    return got.select(*(F.col("b")[n]["value"].cast(typed(n)).alias(n) for n in names))
