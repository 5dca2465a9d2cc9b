"""Graph algebra on triple frames: union, provenance, disambiguation, node rewriting, difference, chunks, look-ups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeweave.functions.columns import n3
from lodeweave.functions.vocab import BASE, DROPPED_TYPES, NAMESPACES, RDF_TYPE
from lodeweave.sources.scratch import materialize

TERM = ("s", "p", "o", "o_kind", "o_dtype")


def with_n3(triples: DataFrame) -> DataFrame:
    """Adds N3 texts s_n3, p_n3, o_n3; subjects that start with ``_:`` are blank nodes."""
    s = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(n3(F.col("s"), F.lit("uri")))
    o = F.when(F.col("o_kind") == "bnode", F.col("o")).otherwise(n3(F.col("o"), F.col("o_kind"), F.col("o_dtype")))
    return triples.withColumns({"s_n3": s, "p_n3": n3(F.col("p"), F.lit("uri")), "o_n3": o})


def union_graphs(*graphs: DataFrame) -> DataFrame:
    """Set union; at least one graph is needed."""
    if not graphs:
        raise ValueError("no graphs to integrate")
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return out.distinct()


def first_writer(rows: DataFrame, keys: Sequence[str], seq: Sequence[Column]) -> DataFrame:
    """The first row of each statement in an explicit order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*seq))).filter("_n = 1").drop("_n")


def disambiguate(statements: DataFrame, keys: Sequence[str] = TERM, confidence: str = "confidence", time: str = "extraction_time", ties: Sequence[str] = ("method",)) -> DataFrame:
    """The best provenance per statement: highest confidence, then latest, then a stable order."""
    order = [F.col(confidence).desc_nulls_last(), F.col(time).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)]
    return first_writer(statements, keys, order)


def reify(statements: DataFrame, base: str = BASE) -> DataFrame:
    """Seven rows per statement (node, predicate, object): its type, parts, method, confidence and time."""
    meta = lambda x: F.lit(base + "meta/" + x)
    node = F.concat(F.lit("_:"), F.md5(F.concat_ws("\u0001", "s", "p", "o", "method", F.col("confidence").cast("string"), F.col("extraction_time").cast("string"))))
    pair = lambda p, o: F.struct(p.alias("predicate"), o.cast("string").alias("object"))
    rows = F.array(
        pair(F.lit(RDF_TYPE), meta("StatementMetadata")),
        pair(meta("subject"), F.col("s")),
        pair(meta("predicate"), F.col("p")),
        pair(meta("object"), F.col("o")),
        pair(meta("extractionMethod"), F.col("method")),
        pair(meta("confidence"), F.col("confidence")),
        pair(meta("extractionTime"), F.col("extraction_time")),
    )
    return statements.select(node.alias("node"), F.explode(rows).alias("r")).select("node", "r.predicate", "r.object")


def pivot_metadata(reified: DataFrame, base: str = BASE) -> DataFrame:
    """Back from seven rows a node to one: a grouped pivot over the known predicates."""
    names = ("subject", "predicate", "object", "extractionMethod", "confidence", "extractionTime")
    uris = [base + "meta/" + n for n in names]
    out = reified.filter(F.col("predicate").isin(*uris)).groupBy("node").pivot("predicate", uris).agg(F.first("object"))
    return out.select("node", *(F.col(f"`{u}`").alias(n) for u, n in zip(uris, names)))


def rename_nodes(triples: DataFrame, names: DataFrame) -> DataFrame:
    """Rewrites nodes on both sides by a map (old, new); literals stay."""
    m = names.select("old", "new").dropDuplicates(["old"])
    out = triples.join(m.select(F.col("old").alias("_s"), F.col("new").alias("_sn")), F.col("s") == F.col("_s"), "left")
    out = out.join(m.select(F.col("old").alias("_o"), F.col("new").alias("_on")), (F.col("o") == F.col("_o")) & (F.col("o_kind") != "literal"), "left")
    renamed = F.col("_on").isNotNull()
    return out.select(
        *[c for c in triples.columns if c not in ("s", "o", "o_kind")],
        F.coalesce("_sn", "s").alias("s"),
        F.coalesce("_on", "o").alias("o"),
        F.when(renamed & ~F.col("_on").startswith("_:"), "uri").otherwise(F.col("o_kind")).alias("o_kind"),
    ).select(*triples.columns)


def nodes_of_type(triples: DataFrame, types: Sequence[str]) -> DataFrame:
    return triples.filter((F.col("p") == RDF_TYPE) & F.col("o").isin(*types)).select(F.col("s").alias("node")).distinct()


def delete_typed_nodes(triples: DataFrame, types: Sequence[str] = DROPPED_TYPES) -> DataFrame:
    """Without the nodes of some types, on either side."""
    gone = nodes_of_type(triples, types)
    left = triples.join(gone.select(F.col("node").alias("s")), "s", "left_anti")
    return left.join(gone.select(F.col("node").alias("o")), "o", "left_anti").select(*triples.columns)


def blank_nodes_with_type(triples: DataFrame) -> DataFrame:
    """(node, type) of the blank nodes that state a type."""
    return triples.filter(F.col("s").startswith("_:") & (F.col("p") == RDF_TYPE)).select(F.col("s").alias("node"), F.col("o").alias("type")).distinct()


def drop_blank_nodes(triples: DataFrame) -> DataFrame:
    """Without triples that touch a blank node."""
    return triples.filter(~F.col("s").startswith("_:") & (F.col("o_kind") != "bnode"))


def croissant_graph(triples: DataFrame, dataset_id: str, platform: str, types: Sequence[str] = DROPPED_TYPES, base: str = BASE) -> DataFrame:
    """Dataset description: file nodes go, typed blank nodes get hashed names (the dataset by its id, others by name), the rest of the blank
    nodes goes.  ``triples`` carries the dataset's id in a column, so all descriptions are rewritten in one pass."""
    from lodeweave.functions.columns import entity_uri

    kept = delete_typed_nodes(triples, types)
    typed = kept.filter(F.col("s").startswith("_:") & (F.col("p") == RDF_TYPE)).select(F.col("s").alias("node"), F.substring_index(F.regexp_replace("o", "#", "/"), "/", -1).alias("type"), dataset_id)
    label = kept.filter(F.col("p") == NAMESPACES["schema"] + "name").groupBy(F.col("s").alias("node")).agg(F.min("o").alias("name"))
    named = typed.filter(F.col("type").isin("Dataset", "Organization", "Person")).join(label, "node", "left")
    ident = F.when(F.col("type") == "Dataset", F.col(dataset_id)).otherwise(F.replace(F.col("name"), F.lit(" "), F.lit("_")))
    new = F.when(ident.startswith("https"), ident).otherwise(entity_uri(platform, F.col("type"), ident, base=base))
    names = named.filter(ident.isNotNull()).select(F.col("node").alias("old"), new.alias("new"))
    return drop_blank_nodes(rename_nodes(kept, names)).distinct()


def subtract(current: DataFrame, gone: DataFrame, keys: Sequence[str] = ("s", "p", "o")) -> DataFrame:
    """Triples of the current graph that are not in the other (an anti join)."""
    return current.join(gone.select(*keys).distinct(), list(keys), "left_anti").select(*current.columns)


def move_deprecated(graphs: DataFrame, gone: DataFrame, current: str, deprecated: str) -> DataFrame:
    """(g, s, p, o) after a named-graph difference: matching triples leave the current graph and join the deprecated one."""
    keys = ["s", "p", "o"]
    d = gone.select(*keys).distinct()
    live = graphs.filter(F.col("g") == current).join(d, keys, "left_anti")
    rest = graphs.filter(F.col("g") != current)
    return live.unionByName(rest).unionByName(d.withColumn("g", F.lit(deprecated)).select(*live.columns)).distinct()


def _run_table(n: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a run of subjects with ``n`` triples each does to a fold that closes a chunk at ``need`` triples: for each place at which the chunk that is
    open before the run may close (triples of the run up to there), the chunks that close in the run and the triples held after it."""
    total = np.cumsum(n)
    begin = np.concatenate(([0], total))  # triples before each subject, and after the last
    close = np.searchsorted(total, begin + need)  # the subject that closes a chunk begun at each subject, or none
    closed, held = np.zeros(len(begin), np.int64), begin[-1] - begin
    for i in range(len(n) - 1, 0, -1):
        if (at := close[i] + 1) <= len(n):
            closed[i], held[i] = closed[at] + 1, held[at]
    ends = min(len(n), int(close[0]) + 1)  # with nothing held before, it closes there; with more, earlier
    return total[:ends], closed[1 : ends + 1] + 1, held[1 : ends + 1]


def subject_chunks(triples: DataFrame, size: int, weight: int = 7, per_run: int = 200_000) -> DataFrame:
    """(subject, n, chunk_id): subjects in order, whole, chunks closed once ``weight`` times their triples reach ``size`` (0: one chunk).

    Restarting at a threshold is one fold over all subjects in order; its result does not depend on how the subjects are dealt.  Ranges of about
    ``per_run`` subjects each give a table of what they do to the fold (see :func:`_run_table`, at most as many entries as triples in a chunk or
    subjects in the run); the driver walks over the tables, one at a time, for what is held before each run, and the runs are folded from there.
    """
    counts = triples.groupBy(F.col("s").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    if size <= 0:
        return counts.withColumn("chunk_id", F.lit(1).cast("long"))
    spark, need = triples.sparkSession, -(-size // weight)
    counts = materialize(counts, "subjects")
    runs = 1 + counts.count() // per_run
    dealt = counts.repartitionByRange(runs, F.col("subject").asc_nulls_last()).withColumn("run", F.spark_partition_id())
    dealt = materialize(dealt, "runs")

    def in_order(pdf):
        return pdf.sort_values("subject", kind="stable")

    def survey(key, pdf):
        parts = _run_table(in_order(pdf)["n"].to_numpy(), need)
        return pd.DataFrame([(*key, int(pdf["n"].sum()), *(x.astype(np.int64).tobytes() for x in parts))], columns=["run", "total", "ends", "closed", "held"])

    tables = materialize(dealt.groupBy("run").applyInPandas(survey, "run int, total long, ends binary, closed binary, held binary"), "tables")
    before, held, starts = 0, 0, []
    for r in tables.orderBy("run").toLocalIterator():
        starts.append((r["run"], before, held))
        ends, closed, after = (np.frombuffer(r[c], np.int64) for c in ("ends", "closed", "held"))
        at = int(np.searchsorted(ends, need - held))
        if at < len(ends):
            before, held = before + int(closed[at]), int(after[at])
        else:
            held += r["total"]
    known = spark.createDataFrame(starts, "run int, _before long, _held long")

    def fold(pdf):
        pdf = in_order(pdf)
        chunk, held, out = int(pdf["_before"].iat[0]) + 1, int(pdf["_held"].iat[0]), []
        for n in pdf["n"].tolist():
            if held >= need:
                chunk, held = chunk + 1, 0
            out.append(chunk)
            held += n
        return pdf.assign(chunk_id=out)[["subject", "n", "chunk_id"]]

    return dealt.join(F.broadcast(known), "run").groupBy("run").applyInPandas(fold, "subject string, n long, chunk_id long")


def entity_lookup(triples: DataFrame) -> DataFrame:
    """(s, p, objects): the objects of each subject and predicate as a sorted list."""
    return triples.groupBy("s", "p").agg(F.array_sort(F.collect_list("o")).alias("objects"))


def resolve_names(triples: DataFrame, predicates: Sequence[str], name_predicate: str = NAMESPACES["schema"] + "name", named: DataFrame | None = None) -> DataFrame:
    """Adds ``shown``: for the given predicates the name of the object's entity (the least of several), else the object's own text.

    ``named``: the graph that names are taken from, if ``triples`` is a part of it.
    """
    shown = F.coalesce(F.col("p").isin(*predicates) & (F.col("o_kind") != "literal"), F.lit(False))
    asked = triples.filter(shown)
    # only names that are asked for are gathered, and only rows that ask are joined: the rest (types, say) may share one object
    names = (triples if named is None else named).filter(F.col("p") == name_predicate).select(F.col("s").alias("_e"), F.col("o").alias("_name"))
    names = names.join(asked.select(F.col("o").alias("_e")).distinct(), "_e", "left_semi").groupBy("_e").agg(F.min("_name").alias("_name"))
    out = asked.join(names, F.col("o") == F.col("_e"), "left").withColumn("shown", F.coalesce("_name", "o")).drop("_e", "_name")
    return out.unionByName(triples.filter(~shown).withColumn("shown", F.col("o")))


def match(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Basic graph pattern with constants; the filters reach the scan."""
    for c, v in (("s", s), ("p", p), ("o", o)):
        if v is not None:
            triples = triples.filter(F.col(c) == v)
    return triples


def named_graph(quads: DataFrame, g: str) -> DataFrame:
    """The triples of one named graph."""
    return quads.filter(F.col("g") == g).drop("g").distinct()


def insert_triples(quads: DataFrame, triples: DataFrame, g: str) -> DataFrame:
    """A named graph grown by triples; what it holds already is not added again."""
    new = triples.withColumn("g", F.lit(g)).select(*quads.columns)
    return quads.unionByName(new).distinct()


def delete_triple(quads: DataFrame, g: str, s: str, p: str, o: str) -> DataFrame:
    """A named graph without one triple."""
    return quads.filter(~((F.col("g") == g) & (F.col("s") == s) & (F.col("p") == p) & (F.col("o") == o)))
