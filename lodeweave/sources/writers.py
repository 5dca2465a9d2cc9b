"""Writers: N-Triples, Turtle, record files, numbered chunk pairs, local manifest of chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.functions.columns import n3
from lodeweave.functions.vocab import BASE, NAMESPACES, RDF_TYPE
from lodeweave.operators.graph import subject_chunks, with_n3
from lodeweave.sources.scratch import materialize


def ntriples_lines(triples: DataFrame) -> DataFrame:
    return with_n3(triples).select(F.concat_ws(" ", "s_n3", "p_n3", "o_n3", F.lit(".")).alias("value"))


def write_ntriples(triples: DataFrame, path: str) -> None:
    ntriples_lines(triples).write.mode("overwrite").text(path)


def turtle_blocks(triples: DataFrame) -> DataFrame:
    """One text per subject; a subject's predicates and objects are sorted."""
    rows = with_n3(triples).groupBy("s_n3", "p_n3").agg(F.array_join(F.array_sort(F.collect_set("o_n3")), ", ").alias("objects"))
    pairs = F.array_sort(F.collect_list(F.concat_ws(" ", "p_n3", "objects")))
    return rows.groupBy("s_n3").agg(pairs.alias("pairs")).select(F.concat(F.col("s_n3"), F.lit(" "), F.array_join("pairs", " ;\n    "), F.lit(" .")).alias("value"))


def write_turtle(triples: DataFrame, path: str) -> None:
    turtle_blocks(triples).write.mode("overwrite").text(path)


def metadata_lines(statements: DataFrame, *keep: str) -> DataFrame:
    """N-Triples of the reified statements: a line for each part that a statement has (seven with all of its provenance), as terms."""
    given = {c: F.col(c).cast("string") if c in statements.columns else F.lit(None).cast("string") for c in ("method", "confidence", "extraction_time")}
    rows = with_n3(statements)
    node = F.concat(F.lit("_:m"), F.md5(F.concat_ws("\u0001", "s_n3", "p_n3", "o_n3", *given.values())))
    meta = lambda x: n3(F.lit(BASE + "meta/" + x), F.lit("uri"))
    text = lambda c, kind: n3(given[c], F.lit("literal"), F.lit(NAMESPACES["xsd"] + kind))
    parts = [
        (n3(F.lit(RDF_TYPE), F.lit("uri")), meta("StatementMetadata")),
        (meta("subject"), F.col("s_n3")),
        (meta("predicate"), F.col("p_n3")),
        (meta("object"), F.col("o_n3")),
        (meta("extractionMethod"), text("method", "string")),
        (meta("confidence"), text("confidence", "double")),
        (meta("extractionTime"), text("extraction_time", "string")),
    ]
    lines = F.array(*(F.when(o.isNotNull(), F.concat_ws(" ", node, p, o, F.lit("."))) for p, o in parts))
    return rows.select(*keep, F.explode(F.array_compact(lines)).alias("value"))


def jsonld_nodes(triples: DataFrame) -> DataFrame:
    """One expanded JSON-LD node per subject (subject, value): types, and for each predicate a sorted list of references and literals."""
    literal = F.to_json(F.struct(F.col("o_dtype").alias("@type"), F.col("o").alias("@value")))
    o = F.when(F.col("p") == RDF_TYPE, F.to_json(F.array("o")).substr(F.lit(2), F.length(F.to_json(F.array("o"))) - 2)).when(F.col("o_kind") == "literal", literal).otherwise(F.to_json(F.struct(F.col("o").alias("@id"))))
    key = F.when(F.col("p") == RDF_TYPE, "@type").otherwise(F.col("p"))
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    pairs = triples.select("s", key.alias("key"), o.alias("o")).groupBy("s", "key").agg(F.array_join(F.array_sort(F.collect_set("o")), ",").alias("items"))
    fields = pairs.groupBy("s").agg(F.array_join(F.array_sort(F.collect_list(F.concat(quoted(F.col("key")), F.lit(":["), F.col("items"), F.lit("]")))), ",").alias("fields"))
    return fields.select(F.col("s").alias("subject"), F.concat(F.lit('{"@id":'), quoted(F.col("s")), F.lit(","), F.col("fields"), F.lit("}")).alias("value"))


def write_jsonld(triples: DataFrame, path: str) -> None:
    """Expanded JSON-LD, a node a line."""
    jsonld_nodes(triples).select("value").write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str, kind: str = "json") -> None:
    """Records as JSON lines or tab-separated text."""
    writer = df.write.mode("overwrite")
    writer.json(path) if kind == "json" else writer.csv(path, sep="\t", header=True)


def write_by_type(records: DataFrame, path: str, col: str = "kind") -> None:
    """One folder of records per type."""
    records.write.mode("overwrite").partitionBy(col).json(path)


def write_chunks(triples: DataFrame, statements: DataFrame, size: int, path: str, per_file: int = 1_000_000) -> DataFrame:
    """Numbered chunks of whole subjects, graph lines and their metadata side by side; returns the manifest (chunk_id, subjects, triples, status).

    A chunk's rows are brought together before they are written: one file a chunk, or one for every ``per_file`` triples of it, whatever the number of
    tasks.  Files of each task in each chunk would be too many to list on the driver.  Triples are never broadcast: where a few columns were exploded
    to them, the planner takes them for as small as those.
    """
    chunks = materialize(subject_chunks(triples, size), "chunks")
    manifest = chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("subjects"), F.sum("n").alias("triples")).withColumn("status", F.lit("written"))
    by = chunks.join(manifest.select("chunk_id", F.floor(F.col("triples") / per_file + 1).alias("_files")), "chunk_id").select(F.col("subject").alias("s"), "chunk_id", "_files")
    together = lambda df: df.withColumn("_file", F.pmod(F.xxhash64("p", "o"), "_files")).repartition("chunk_id", "_file").drop("_file", "_files")
    ntriples_part = with_n3(together(triples.hint("merge").join(by, "s"))).select("chunk_id", F.concat_ws(" ", "s_n3", "p_n3", "o_n3", F.lit(".")).alias("value"))
    ntriples_part.write.mode("overwrite").partitionBy("chunk_id").text(f"{path}/kg")
    rows = metadata_lines(together(statements.hint("merge").join(by, "s")), "chunk_id")
    rows.write.mode("overwrite").partitionBy("chunk_id").text(f"{path}/metadata")
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest
