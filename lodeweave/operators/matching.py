"""Matching sections to questions by embeddings, and question answering around injected models."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_TERM = re.compile(r"[^\W_]+")


class Embedder(Protocol):
    """Anything that maps texts to vectors; see :func:`hashed_vector` for the default."""

    def __call__(self, text: Column) -> Column: ...


def hashed_vector(text: Column, dims: int = 256) -> Column:
    """Deterministic bag-of-words vector by hashing (an Arrow function: built-in expressions would pass over the words once per dimension)."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        slots = (np.array([zlib.crc32(w.encode()) % dims for w in _TERM.findall((t or "").lower())], np.int64) for t in texts)
        return pd.Series([np.bincount(s, minlength=dims).astype(np.float32) for s in slots])

    return embed(text)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if a vector is zero."""
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norm == 0, 0.0).otherwise(_dot(a, b) / norm)


def with_norm(df: DataFrame, vec: str) -> DataFrame:
    """Adds ``<vec>_n``, the vector's norm, so that a join computes one product per pair instead of three."""
    return df.withColumn(f"{vec}_n", F.sqrt(_dot(F.col(vec), F.col(vec))))


def top_k(questions: DataFrame, items: DataFrame, k: int, q_id: str, q_vec: str, i_id: str, i_vec: str, within: Sequence[str] = (), places: int = 6) -> DataFrame:
    """(q_id, i_id, score, rank): the k most similar items of each question, ties by item id.

    ``within``: columns that question and item must share (then an equi-join); without, every question meets every item, block by block.
    """
    if not within:
        return _top_k_blocks(questions, items, k, q_id, q_vec, i_id, i_vec, places)
    q = with_norm(questions.select(*within, F.col(q_id).alias("_q"), F.col(q_vec).alias("_qv")), "_qv")
    i = with_norm(items.select(*within, F.col(i_id).alias("_i"), F.col(i_vec).alias("_iv")), "_iv")
    pairs = q.join(i, list(within))
    norm = F.col("_qv_n") * F.col("_iv_n")
    scored = pairs.select(*within, "_q", "_i", F.round(F.when(norm == 0, 0.0).otherwise(_dot(F.col("_qv"), F.col("_iv")) / norm), places).alias("score"))
    order = Window.partitionBy(*within, "_q").orderBy(F.col("score").desc(), "_i")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(*within, F.col("_q").alias(q_id), F.col("_i").alias(i_id), "score", "rank")


def _blocks(df: DataFrame, ident: str, vec: str, size: int, name: str) -> DataFrame:
    """Rows in blocks of about ``size``, each sorted by id."""
    n = max(1, -(-df.count() // size))
    rows = df.filter(F.size(vec) > 0).groupBy(F.pmod(F.xxhash64(ident), F.lit(n)).alias("_b")).agg(F.array_sort(F.collect_list(F.struct(F.col(ident).alias("id"), F.col(vec).cast("array<double>").alias("vec")))).alias("_x"))
    return rows.select(F.transform("_x", lambda x: x["id"]).alias(f"{name}_ids"), F.transform("_x", lambda x: x["vec"]).alias(f"{name}_vecs"))


def _top_k_blocks(questions: DataFrame, items: DataFrame, k: int, q_id: str, q_vec: str, i_id: str, i_vec: str, places: int, block: int = 2048) -> DataFrame:
    """Blocks of questions meet blocks of items as matrices; each pair of blocks leaves ``k`` items a question, so what is ranked in the end is small."""
    kinds = {n: t for df in (questions, items) for n, t in df.dtypes}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q_vecs, i_ids, i_vecs = (batch.column(c)[row].values for c in range(4))
                dims = len(q_vecs[0])
                q, i = (v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) for v in (q_vecs, i_vecs))
                norm = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((i * i).sum(1))[None, :]
                score = np.rint(np.divide(q @ i.T, norm, out=np.zeros_like(norm), where=norm != 0) * 10**places)
                # ids ascend within a block: of equal scores the first place wins
                order = score.astype(np.int64) * len(i) - np.arange(len(i))
                top = np.argpartition(-order, min(k, len(i)) - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [q_ids.take(pa.array(np.repeat(np.arange(len(q)), top.shape[1]))), i_ids.take(pa.array(top.ravel())), pa.array(np.take_along_axis(score, top, 1).ravel() / 10**places)], names=["q", "i", "score"]
                )

    pairs = _blocks(items, i_id, i_vec, 2 * block, "i").crossJoin(_blocks(questions, q_id, q_vec, block, "q")).select("q_ids", "q_vecs", "i_ids", "i_vecs")
    some = pairs.mapInArrow(best, f"q {kinds[q_id]}, i {kinds[i_id]}, score double")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "i"))).filter(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(q_id), F.col("i").alias(i_id), "score", "rank")


def context_match(questions: DataFrame, items: DataFrame, but_itself: bool = False, **kw) -> DataFrame:
    """Best item per question, with its score as confidence and a fixed method name; ``but_itself``: an item is no answer to the question of its own id."""
    best = top_k(questions, items, 2 if but_itself else 1, **kw)
    if but_itself:
        best = best.filter(F.col(kw["q_id"]) != F.col(kw["i_id"])).withColumn("first", F.min("rank").over(Window.partitionBy(*kw.get("within", ()), kw["q_id"]))).filter("rank = first").drop("first")
    return best.drop("rank").withColumnRenamed("score", "confidence").withColumn("method", F.lit("DirectContextMatch_SectionContent"))


def cluster_questions(vectors: Sequence[Sequence[float]], n: int) -> list[int]:
    """Average-linkage clusters of a few dozen questions; the rows of the distance matrix serve as features."""
    x = np.asarray(vectors, float)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    f = 1 - x @ x.T
    d = np.sqrt(np.maximum(((f[:, None] - f[None, :]) ** 2).sum(-1), 0))
    groups = [[i] for i in range(len(f))]
    while len(groups) > max(1, n):
        _, a, b = min((d[np.ix_(groups[a], groups[b])].mean(), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        groups[a] += groups.pop(b)
    label = [0] * len(f)
    for k, g in enumerate(groups):
        for i in g:
            label[i] = k
    return label


def group_questions(vectors: Sequence[Sequence[float]], most: int) -> list[list[int]]:
    """Clusters of at most ``most`` questions."""
    labels = cluster_questions(vectors, max(1, len(vectors) // max(1, most)))
    groups: dict[int, list[int]] = {}
    for i, k in enumerate(labels):
        groups.setdefault(k, []).append(i)
    return [g[a : a + most] for g in groups.values() for a in range(0, len(g), most)]


def batch_by_context(rows: DataFrame, context: str, order: Sequence[Column], size: int) -> DataFrame:
    """Adds ``batch``: questions of one context in runs of ``size``."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(context).orderBy(*order)) - 1) / size))


def mean_score(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    return scores.groupBy(*keys).agg(F.avg("score").alias("mean_score"))


def prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question, F.lit("\n\nAnswer:"))


def multi_prompt(questions: Column, context: Column) -> Column:
    listed = F.array_join(F.transform(questions, lambda q, i: F.concat((i + 1).cast("string"), F.lit(". "), q)), "\n")
    return F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestions:\n"), listed, F.lit("\n\nAnswers:"))


def answers(response: Column, n: int) -> Column:
    """Answers of a numbered response, '' where one is missing, the first of a repeated number (built-in expressions)."""
    part = lambda k: F.regexp_extract_all(response, F.lit(r"(?m)^\s*(?:Answer\s*)?(\d+)[.:)]\s*(.*)$"), F.lit(k))
    numbers, texts = part(1), part(2)
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.coalesce(F.get(texts, F.array_position(numbers, i.cast("string")).cast("int") - 1), F.lit("")))


_NUMBERED = re.compile(r"\s*(?:Answer\s*)?(\d+)[.:)]\s*(.*)", re.I)


def parse_answers(response: str, n: int) -> list[str]:
    """The same with answers that go on over lines; numbers out of range are ignored, missing answers are ''."""
    out: dict[int, list[str]] = {}
    at = 0
    for line in response.split("\n"):
        if m := _NUMBERED.match(line):
            at = int(m[1])
            out[at] = [m[2].strip()] if at not in out else out[at]
        elif at and line.strip():
            out[at].append(line.strip())
    return [" ".join(x for x in out.get(i, []) if x) for i in range(1, n + 1)]


def answer_with(model: Callable[[list[str]], list[str]]):
    """Arrow UDF around an injected model: prompts to answers, '' for null prompts."""
    @F.pandas_udf("string")
    def run(prompts: pd.Series) -> pd.Series:
        got = iter(model([p for p in prompts if p is not None]))
        return pd.Series(["" if p is None else next(got) for p in prompts])

    return run


def answer_questions(questions: DataFrame, model: Callable[[list[str]], list[str]], time: Column) -> DataFrame:
    """(question, context) rows to answers; an empty context is answered by a fixed text without asking the model."""
    asked = F.when(F.length(F.coalesce("context", F.lit(""))) > 0, prompt(F.col("question"), F.col("context")))
    return questions.withColumn("answer", answer_with(model)(asked)).withColumn("answer", F.when(asked.isNull(), "No context to answer the question").otherwise(F.col("answer"))).withColumn("extraction_time", time)


#: Position of the row that stands for a document's whole text.
WHOLE = -1
#: Questions that one run may ask of each document; they are sent to every task.
MOST_QUESTIONS = 1_000


def with_whole_texts(sections: DataFrame, docs: DataFrame) -> DataFrame:
    """Sections (doc_id, pos, content), and for documents (doc_id, text) without any the whole text; such a row matches with score 1."""
    bare = docs.join(sections.select("doc_id").distinct(), "doc_id", "left_anti").filter(F.length("text") > 0)
    return sections.select("doc_id", "pos", "content").unionByName(bare.select("doc_id", F.lit(WHOLE).alias("pos"), F.col("text").alias("content")))


def whole_scores(best: DataFrame) -> DataFrame:
    return best.withColumn("score", F.when(F.col("pos") == WHOLE, 1.0).otherwise(F.col("score")))


def small_questions(questions: DataFrame) -> DataFrame:
    """The questions, marked for broadcast after their number is checked."""
    if questions.limit(MOST_QUESTIONS + 1).count() > MOST_QUESTIONS:
        raise ValueError(f"more than {MOST_QUESTIONS} questions")
    return F.broadcast(questions)


def merge_answers(rows: DataFrame, answers: DataFrame, key: str, properties: Sequence[str]) -> DataFrame:
    """Answers (key, property, data, confidence, method) as a column each, beside the rows they belong to; of several the surest, then the least."""
    cell = F.min(F.struct((-F.col("confidence")).alias("rank"), "data", "method", "confidence")).alias("cell")
    wide = answers.groupBy(key, "property").agg(cell).groupBy(key).pivot("property", list(properties)).agg(F.first("cell"))
    shown = [F.struct(*(F.col(f"`{p}`.{f}").alias(f) for f in ("data", "method", "confidence"))).alias(p) for p in properties]
    return rows.join(wide.select(key, *shown), key, "left")


def question_columns(rows: DataFrame, key: str, text: str, sections: DataFrame, questions: DataFrame, embed: Embedder = hashed_vector) -> DataFrame:
    """The rows with a column for each question (property), filled by the best matching section, or the whole text of a row without sections."""
    names = [r[0] for r in small_questions(questions).select("property").distinct().orderBy("property").collect()]
    all_ = with_whole_texts(sections, rows.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    found = extract_properties(all_, questions, "context_matching", embed=embed).withColumnRenamed("doc_id", key)
    return merge_answers(rows, found, key, names)


STRATEGIES = ("context_matching", "grouped", "individual")


def extract_properties(sections: DataFrame, questions: DataFrame, strategy: str, model: Callable[[list[str]], list[str]] | None = None, k: int = 3, embed: Embedder = hashed_vector, time: Column | None = None, most: int = 5) -> DataFrame:
    """Properties from sections (doc_id, pos, content) for questions (property, question): (doc_id, property, data, confidence, method).

    ``context_matching`` takes the best section; ``grouped`` clusters the questions into groups of at most ``most``, asks a group in one prompt
    over the ``k`` best sections of its first question and reads the numbered answers (a lone question is asked as it is); any other strategy
    answers each question over its own ``k`` best ones.  Both use the injected model.
    """
    if strategy == "grouped":
        if model is None:
            raise ValueError("this strategy needs a model")
        return _grouped(sections, questions, model, k, embed, most)
    # a document holds few questions per section, so pairs stay within documents: an equi-join on doc_id
    asks = sections.select("doc_id").distinct().crossJoin(small_questions(questions).select("property", "question", embed(F.col("question")).alias("qv")))
    items = sections.select("doc_id", "pos", embed(F.col("content")).alias("iv"))
    best = whole_scores(top_k(asks, items, 1 if strategy == "context_matching" else k, "property", "qv", "pos", "iv", ["doc_id"])).join(sections.select("doc_id", "pos", "content"), ["doc_id", "pos"])
    if strategy == "context_matching":
        return best.select("doc_id", "property", F.col("content").alias("data"), F.col("score").alias("confidence"), F.lit("DirectContextMatch_SectionContent").alias("method"))
    if model is None:
        raise ValueError("this strategy needs a model")
    ctx = best.groupBy("doc_id", "property").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "content"))), lambda x: x["content"]), "\n\n").alias("context"), F.avg("score").alias("confidence"))
    out = answer_questions(ctx.join(questions.select("property", "question"), "property"), model, time if time is not None else F.current_timestamp())
    return out.select("doc_id", "property", F.col("answer").alias("data"), "confidence", F.lit("individual_qa").alias("method"))


def _grouped(sections: DataFrame, questions: DataFrame, model: Callable[[list[str]], list[str]], k: int, embed: Embedder, most: int) -> DataFrame:
    """Grouped answers; the few dozen questions and their vectors are held by the driver."""
    asked = small_questions(questions).select("property", "question", embed(F.col("question")).alias("qv")).orderBy("property", "question").collect()
    rows = [(g, i, asked[q]["property"], asked[q]["question"], list(map(float, asked[q]["qv"]))) for g, group in enumerate(group_questions([r["qv"] for r in asked], most) if asked else []) for i, q in enumerate(sorted(group))]
    groups = F.broadcast(questions.sparkSession.createDataFrame(rows, "grp int, at int, property string, question string, qv array<double>"))
    heads = sections.select("doc_id").distinct().join(groups.filter("at = 0").select("grp", "qv"))
    items = sections.select("doc_id", "pos", embed(F.col("content")).alias("iv"))
    best = whole_scores(top_k(heads, items, k, "grp", "qv", "pos", "iv", ["doc_id"])).join(sections.select("doc_id", "pos", "content"), ["doc_id", "pos"])
    ctx = best.groupBy("doc_id", "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "content"))), lambda x: x["content"]), "\n\n").alias("context"), F.avg("score").alias("confidence"))
    listed = groups.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("at", "property", "question"))).alias("members"))
    texts = F.transform("members", lambda m: m["question"])
    lone = F.size("members") == 1
    prompts = F.when(F.length("context") > 0, F.when(lone, prompt(texts[0], F.col("context"))).otherwise(multi_prompt(texts, F.col("context"))))

    @F.pandas_udf("array<string>")
    def spread(response: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([[r] if m == 1 else parse_answers(r, int(m)) for r, m in zip(response, n)])

    out = ctx.join(F.broadcast(listed), "grp").withColumn("asked", prompts).withColumn("response", answer_with(model)(F.col("asked")))
    out = out.withColumn("got", spread(F.col("response"), F.size("members"))).select("doc_id", "confidence", F.col("asked").isNull().alias("none"), F.explode(F.arrays_zip("members", "got")).alias("x"))
    data = F.when(F.col("none"), "No context to answer the question").otherwise(F.col("x.got"))
    return out.select("doc_id", F.col("x.members.property").alias("property"), data.alias("data"), "confidence", F.lit("grouped_qa").alias("method"))


def question_blocks(properties: DataFrame) -> DataFrame:
    """(property, description, section) to (property, question): name, description and likely sections; properties without a description are skipped."""
    from lodeweave.functions.columns import humanize, strip

    sections = F.filter(F.transform(F.split(F.coalesce("section", F.lit("")), ";"), strip), lambda x: x != "")
    where = F.when(F.size(sections) > 0, F.concat(F.lit("\nSections: "), F.array_join(sections, ", "))).otherwise("")
    some = properties.filter(strip(F.coalesce("description", F.lit(""))) != "")
    return some.select("property", F.concat(humanize(F.col("property")), F.lit(": "), strip(F.col("description")), where).alias("question"))
