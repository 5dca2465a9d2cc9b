"""Extraction operators: card quality, recency, known fields, tags, front matter, licences, extraction cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeweave.functions.columns import drop_first_match, last_segment, strip
from lodeweave.functions.vocab import MIN_CARD_CHARS, MISSING_PHRASE, NOT_FOUND, TEMPLATE_GAPS, TEMPLATE_HITS, TEMPLATE_PHRASES


def is_template_card(card: Column, phrases: Sequence[str] = TEMPLATE_PHRASES, missing: str = MISSING_PHRASE, gaps: int = TEMPLATE_GAPS, hits: int = TEMPLATE_HITS) -> Column:
    """Whether a card is an untouched template: many gaps and nearly all template phrases."""
    n_gaps = (F.length(card) - F.length(F.replace(card, F.lit(missing), F.lit("")))) / len(missing)
    n_hits = sum((F.contains(card, F.lit(p)).cast("int") for p in phrases), F.lit(0))
    return (n_gaps >= gaps) & (n_hits >= hits)


def quality_filter(models: DataFrame, **kw) -> DataFrame:
    """Models with a pipeline tag, a tag, and a card that is long enough and no template (null: rejected)."""
    enough = (F.length("pipeline_tag") > 0) & (F.size("tags") >= 1) & (F.length("card") >= MIN_CARD_CHARS)
    return models.filter(enough & ~is_template_card(F.col("card"), **kw))


def newer_than(df: DataFrame, ts: str, known: DataFrame, known_ts: str) -> DataFrame:
    """Rows later than the newest known one (all rows if none is known)."""
    mark = known.agg(F.max(known_ts).alias("_mark"))
    return df.join(F.broadcast(mark), F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (give a total order)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def page(df: DataFrame, order: Sequence[Column], offset: int = 0, limit: int | None = None) -> DataFrame:
    """A page of a totally ordered frame."""
    out = df.orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)


def specific(df: DataFrame, key: str, ids: DataFrame | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with the given ids, the last of each; an empty list of ids is a ValueError."""
    if not isinstance(ids, DataFrame):
        if not ids:
            raise ValueError("no ids given")
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], [key])
    return keep_last(df.join(ids, key, "left_semi"), [key], order)


def known_fields(models: DataFrame, hub: str = "https://huggingface.co/") -> DataFrame:
    """Fields that a raw model record states itself."""
    url = F.concat(F.lit(hub), F.col("modelId"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return models.select(
        F.col("modelId").alias("entity"),
        last_segment(F.col("modelId")).alias("schema.org:name"),
        F.col("author").alias("fair4ml:sharedBy"),
        iso("createdAt").alias("schema.org:dateCreated"),
        iso("createdAt").alias("schema.org:datePublished"),
        iso("last_modified").alias("schema.org:dateModified"),
        drop_first_match(F.col("card"), r"(?s)---.*?---").alias("schema.org:description"),
        *(url.alias(c) for c in ("schema.org:identifier", "schema.org:url", "schema.org:archivedAt")),
        *(F.concat(url, F.lit("/discussions")).alias(c) for c in ("schema.org:discussionUrl", "codemeta:issueTracker")),
        F.concat(url, F.lit("/blob/main/README.md")).alias("codemeta:readme"),
    )


def classify_tags(models: DataFrame, languages: DataFrame, libraries: DataFrame, tasks: DataFrame) -> DataFrame:
    """(entity, tags, pipeline_tag) to sorted distinct lists: datasets, articles, base_models, languages, libraries, tasks, keywords.

    The vocabularies (one column ``name``, lower case) are joined as dimensions; their size decides how Spark joins them.
    """
    tag = models.select("entity", F.explode("tags").alias("tag")).distinct()
    tag = tag.withColumn("low", F.lower("tag")).withColumn("spaced", F.lower(F.replace(F.col("tag"), F.lit("-"), F.lit(" "))))
    mark = lambda dim, name: dim.select(F.col("name").alias(f"_{name}")).distinct()
    tag = tag.join(mark(languages, "lang"), F.col("low") == F.col("_lang"), "left").join(mark(libraries, "lib"), F.col("low") == F.col("_lib"), "left").join(mark(tasks, "task"), F.col("spaced") == F.col("_task"), "left")
    has = lambda s: F.contains("tag", F.lit(s))
    collect = lambda cond, value: F.array_sort(F.collect_set(F.when(cond, value)))
    plain = ~F.contains("tag", F.lit(":")) & F.col("_lang").isNull()
    lists = tag.groupBy("entity").agg(
        collect(has("dataset:"), F.replace(F.col("tag"), F.lit("dataset:"), F.lit(""))).alias("datasets"),
        collect(has("arxiv:"), F.concat(F.lit("https://arxiv.org/abs/"), F.replace(F.col("tag"), F.lit("arxiv:"), F.lit("")))).alias("articles"),
        collect(has("base_model:"), F.substring_index("tag", ":", -1)).alias("base_models"),
        collect(F.col("_lang").isNotNull(), F.col("tag")).alias("languages"),
        collect(F.col("_lib").isNotNull(), F.col("low")).alias("libraries"),
        collect(F.col("_task").isNotNull(), F.col("spaced")).alias("tasks"),
        collect(plain, F.col("low")).alias("keywords"),
    )
    out = models.select("entity", F.lower(F.replace("pipeline_tag", F.lit("-"), F.lit(" "))).alias("pipe")).distinct().join(lists, "entity", "left")
    empty = F.array().cast("array<string>")
    names = ("datasets", "articles", "base_models", "languages", "libraries", "tasks", "keywords")
    out = out.select("entity", "pipe", *(F.coalesce(n, empty).alias(n) for n in names))
    more = F.when(F.col("pipe").isNotNull() & (F.col("pipe") != "") & ~F.array_contains("tasks", F.col("pipe")), F.array("pipe")).otherwise(empty)
    return out.select(
        "entity",
        *names[:5],
        F.array_sort(F.array_distinct(F.concat("tasks", more))).alias("tasks"),
        F.array_sort(F.array_distinct(F.concat("keywords", more))).alias("keywords"),
    )


def flat_yaml(block: Column) -> Column:
    """Map of a front-matter block's flat ``key: value`` lines (nested values are left to :func:`yaml_json`); of a repeated key the last value counts."""
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:\s*\S"))
    pair = lambda x: F.struct(F.regexp_extract(x, r"^([\w-]+):", 1).alias("key"), strip(F.regexp_extract(x, r"^[\w-]+:(.*)$", 1)).alias("value"))
    pairs = F.transform(lines, pair)
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def yaml_fields(block: Column) -> Column:
    """Map of all top-level keys of a front-matter block to texts: scalars as they stand, lists and mappings as JSON; null where it is no mapping.

    Of a repeated key the last value counts.
    """
    return F.from_json(yaml_json()(block), "map<string,string>")


def first_item(value: Column) -> Column:
    """The first item of a JSON list, else the text itself."""
    return F.when(value.startswith("["), F.get_json_object(value, "$[0]")).otherwise(value)


def yaml_json():
    """Arrow UDF: YAML text to JSON text of the mapping; null where it is no valid mapping."""
    @F.pandas_udf("string")
    def parse(blocks: pd.Series) -> pd.Series:
        import json

        import yaml

        def one(text):
            try:
                got = yaml.safe_load(text) if text else None
                return json.dumps(got, default=str) if isinstance(got, dict) else None
            except (yaml.YAMLError, ValueError):
                return None

        return blocks.map(one)

    return parse


def repository_weight() -> Column:
    """The size of a model's repository is not known to its record."""
    return F.lit(NOT_FOUND)


def gated_info(fields: Column) -> Column:
    """Values of the keys about gated access, one a line."""
    return F.array_join(F.map_values(F.map_filter(fields, lambda k, v: F.contains(k, F.lit("extra_gated")))), "\n")


def licence_info(fields: DataFrame, spdx: DataFrame, key: str = "entity", col: str = "fields") -> DataFrame:
    """(key, map) to (key, licence): the canonical SPDX id of ``license_name`` or ``license`` (of a list the first; found by id, then by name), else its text
    and every ``*license*`` key as ``key: value`` lines.  ``spdx``: identifier, name."""
    given = fields.select(key, first_item(F.coalesce(F.try_element_at(col, F.lit("license_name")), F.try_element_at(col, F.lit("license")))).alias("given"), F.col(col).alias("_f"))
    by_id = spdx.select(F.lower("identifier").alias("_id"), F.col("identifier").alias("by_id")).dropDuplicates(["_id"])
    by_name = spdx.select(F.lower("name").alias("_name"), F.col("identifier").alias("by_name")).dropDuplicates(["_name"])
    out = given.join(by_id, F.lower("given") == F.col("_id"), "left").join(by_name, F.lower("given") == F.col("_name"), "left")
    keys = F.map_filter("_f", lambda k, v: F.contains(k, F.lit("license")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries(keys)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select(key, F.coalesce("by_id", "by_name", F.when(F.col("given").isNotNull(), F.concat_ws("\n", "given", lines))).alias("licence"))


def spdx_lookup(names: DataFrame, spdx: DataFrame, col: str = "name") -> DataFrame:
    """Licences found by identifier, else by name; the others are gone.  Adds the licence's page."""
    by_id = names.join(spdx.select(F.lower("identifier").alias("_k"), F.col("identifier").alias("a"), F.col("name").alias("an")), F.lower(col) == F.col("_k"), "left").drop("_k")
    both = by_id.join(spdx.select(F.lower("name").alias("_k"), F.col("identifier").alias("b"), F.col("name").alias("bn")), F.lower(col) == F.col("_k"), "left").drop("_k")
    ident = F.coalesce("a", "b")
    return both.filter(ident.isNotNull()).select(F.col(col).alias("given"), ident.alias("identifier"), F.coalesce("an", "bn").alias("licence_name"), F.concat(F.lit("https://spdx.org/licenses/"), ident, F.lit(".html")).alias("url"))


def cell(data: Column, method: str | Column, confidence: float | Column, time: Column) -> Column:
    """Extraction cell; a missing or empty value becomes the text for 'not found' with confidence 1."""
    missing = data.isNull()
    conf = confidence if isinstance(confidence, Column) else F.lit(float(confidence))
    meth = method if isinstance(method, Column) else F.lit(method)
    return F.struct(F.when(missing, F.lit(NOT_FOUND)).otherwise(data).alias("data"), meth.alias("extraction_method"), F.when(missing, 1.0).otherwise(conf).alias("confidence"), time.alias("extraction_time"))


def to_long(df: DataFrame, key: str, props: Mapping[str, str], method: str, confidence: float, time: Column) -> DataFrame:
    """Wide columns to the long form (entity, property, pos, data, method, confidence, time); lists give a row per item."""
    kinds = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(p).alias("property"), (F.col(f"`{c}`").cast("array<string>") if kinds[c].startswith("array") else F.array(F.col(f"`{c}`").cast("string"))).alias("items")) for p, c in props.items()])
    long = df.select(F.col(key).cast("string").alias("entity"), F.explode(rows).alias("r")).select("entity", "r.property", F.posexplode_outer("r.items").alias("pos", "data"))
    c = cell(F.col("data"), method, confidence, time)
    return long.select("entity", "property", F.coalesce("pos", F.lit(0)).alias("pos"), c["data"].alias("data"), c["extraction_method"].alias("method"), c["confidence"].alias("confidence"), c["extraction_time"].alias("extraction_time"))


def related_names(long: DataFrame, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct names of related entities: (kind, name) from properties grouped by kind."""
    kind = F.lit(None).cast("string")
    for k, props in kinds.items():
        kind = F.when(F.col("property").isin(*props), F.lit(k)).otherwise(kind)
    return long.select(kind.alias("kind"), F.col("data").alias("name")).filter(F.col("kind").isNotNull() & (F.col("name") != NOT_FOUND)).distinct()


def expand(starts: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """(id, depth) of what is reachable over (src, dst) in at most ``depth`` steps, with the fewest steps; each step is a join."""
    seen = starts.select("id").distinct().withColumn("depth", F.lit(0))
    front = seen
    for d in range(1, depth + 1):
        step = front.join(edges, front["id"] == edges["src"]).select(F.col("dst").alias("id")).distinct()
        front = step.join(seen, "id", "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(front)
    return seen


def recent_descriptions(datasets: DataFrame, since: Column, limit: int, doc: str = "croissant_metadata", ts: str = "last_modified", key: str = "datasetId") -> DataFrame:
    """The newest datasets after a time whose description is not empty."""
    held = F.col(doc).isNotNull() & ~F.regexp_replace(doc, r"\s", "").isin("", "{}")
    return page(datasets.filter(held & (F.col(ts) > since)), [F.col(ts).desc(), F.col(key)], 0, limit)


def after_front_matter(card: Column) -> Column:
    """Text after the second ``---``, the whole text without two of them."""
    parts = F.split(card, "---")
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 3, F.size(parts)), "---")).otherwise(card)


def flat_values(cells: Column) -> Column:
    """Data of extraction cells (arrays of texts) as one flat list; a missing text becomes ''."""
    return F.flatten(F.transform(cells, lambda c: F.transform(F.coalesce(c["data"], F.array(F.lit(None).cast("string"))), lambda x: F.coalesce(x, F.lit("")))))


#: Names that a vocabulary may hold which is sent to every task; larger ones are joined (see :func:`classify_tags`).
MOST_NAMES = 10_000


def small_vocabulary(names: DataFrame) -> DataFrame:
    """Distinct names, after their number is checked."""
    out = names.select("name").distinct()
    if out.limit(MOST_NAMES + 1).count() > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    return out


def question_columns(models: DataFrame, tasks: DataFrame, languages: DataFrame, libraries: DataFrame, time: Column) -> DataFrame:
    """Oldest form: answers by question column (repeats of tags are kept).

    q_id_0 name, 1 author, 2 creation date, 3 task, 4 datasets, 13 languages, 15 articles, 16 keywords, 17 libraries, 26 page, 30 download count.
    """
    entry = lambda c: F.array(F.struct(c.alias("data"), F.lit("Parsed_from_HF_dataset").alias("extraction_method"), F.lit(1.0).alias("confidence"), time.alias("extraction_time")))
    pick = lambda keep, value=lambda t: t: F.filter(F.transform("tags", lambda t: F.when(keep(t), value(t))), lambda t: t.isNotNull())
    words = lambda df, name: F.broadcast(small_vocabulary(df).agg(F.collect_set("name").alias(name)))
    m = models.join(words(tasks, "_tasks")).join(words(languages, "_langs")).join(words(libraries, "_libs"))
    low = lambda t: F.lower(F.replace(t, F.lit("-"), F.lit(" ")))
    return m.select(
        F.col("modelId"),
        entry(F.col("modelId")).alias("q_id_0"),
        entry(F.col("author")).alias("q_id_1"),
        entry(F.date_format("createdAt", "yyyy-MM-dd'T'HH:mm:ss")).alias("q_id_2"),
        entry(pick(lambda t: F.array_contains("_tasks", low(t)), low)).alias("q_id_3"),
        entry(pick(lambda t: F.contains(t, F.lit("dataset:")), lambda t: F.replace(t, F.lit("dataset:"), F.lit("")))).alias("q_id_4"),
        entry(pick(lambda t: F.array_contains("_langs", F.lower(t)))).alias("q_id_13"),
        entry(pick(lambda t: F.contains(t, F.lit("arxiv:")), lambda t: F.replace(t, F.lit("arxiv:"), F.lit("")))).alias("q_id_15"),
        entry(pick(lambda t: ~F.contains(t, F.lit(":")))).alias("q_id_16"),
        entry(pick(lambda t: F.array_contains("_libs", F.lower(t)))).alias("q_id_17"),
        entry(F.concat(F.lit("https://huggingface.co/"), "modelId")).alias("q_id_26"),
        entry(F.col("downloads").cast("string")).alias("q_id_30"),
    )
