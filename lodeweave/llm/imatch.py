"""I-Match document fingerprints (DataFrame operations only).

A text's distinct terms are kept if their inverse document frequency lies in a chosen band; the kept terms, sorted, are
cut by several randomised lexicon subsets, and each subset's part is hashed.  A fingerprint is the list of these
hashes; the likeness of two fingerprints is the share of subsets with equal hashes among those that hold a term of either.
Subsets come in levels of falling density, so short and long texts both have subsets that hold few of their terms.

Scale: document frequencies are counted by whole term, combined within each task first.  The band holds few terms (the lower end is a share of all
documents, so at most the terms of a document divided by that share) and is sent with the plan as a Bloom bitmap of 512 KB with two places a term,
instead of a vocabulary that grows with the data; a term outside the band that hits two set places counts as inside, for all texts alike.
The edited text of the contract needs the next document: ids are cut into ranges of like row counts at approximate quantiles, an id (or null) that has
more rows than a range is cut further by a hash of the text, each range gets a copy of its successor's first row, and one shuffle of the texts serves all
windows.

Defined results: null text counts as empty; a text without terms in the band is fingerprinted by all its terms; equal texts have equal
fingerprints; null ids come last in descending order; repeated ids stand in the order of a text hash, and rows that are equal in both follow each other; texts
of any length are fingerprinted whole; an empty table gives an empty result; further columns are ignored (but for :func:`fingerprints`, which keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import documents

CLASS_BITS = 22
#: (bits of density, number of subsets): a term is in a given subset of the level with probability 2 ** -bits.
LEVELS = ((2, 4), (4, 4), (6, 8), (8, 16), (10, 32))
SUBSETS = sum(n for _, n in LEVELS)
TERM_BREAK = r"[^\p{L}\p{N}]+"


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of the lower-cased terms of a text; the low ``CLASS_BITS`` bits are a term's class."""
    words = F.array_remove(F.split(F.lower(text), TERM_BREAK), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _places(term: Column) -> tuple[Column, Column]:
    """A term's two places in the bitmap: the lowest and the highest bits of its hash."""
    return term.bitwiseAND(F.lit((1 << CLASS_BITS) - 1)).cast("int"), F.shiftrightunsigned(term, 64 - CLASS_BITS).cast("int")


def band_terms(texts: DataFrame, least: float = 1e-4, most: float = 0.1) -> DataFrame:
    """Hashes ``t`` of the terms that ``least`` to ``most`` of all documents hold (and two at least)."""
    n = texts.count()
    seen = texts.select(F.explode(term_hashes(F.col("text"))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    return seen.filter((F.col("df") >= max(2.0, least * n)) & (F.col("df") <= max(2.0, most * n))).select("t")


def idf_band(texts: DataFrame, least: float = 1e-4, most: float = 0.1) -> Column:
    """Bloom bitmap (array of longs) of :func:`band_terms`."""
    places = band_terms(texts, least, most).select(F.explode(F.array(*_places(F.col("t")))).alias("c"))
    words = places.groupBy(F.shiftright("c", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(c & 63 as int))")).alias("bits"))
    bitmap = [0] * (1 << (CLASS_BITS - 6))
    for r in words.collect():  # at most 2 ** (CLASS_BITS - 6) rows
        bitmap[r["w"]] = r["bits"]
    return _literal(bitmap, "bigint")


def _literal(values: list, kind: str) -> Column:
    """A constant array, folded once when the query is planned."""
    return F.expr(f"from_json('[{','.join('null' if v is None else str(v) for v in values)}]', 'array<{kind}>')")


#: Bits of a key below the subset's number; a key's lowest bit is set, so a fence (none of them set) sorts before its subset's keys.
_BELOW = 57


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def subset_hashes(terms: Column, band: Column) -> Column:
    """One long per subset, null where the text has no term of the subset in the band.

    Membership is read off disjoint bits of a term's hash, one field a level; all subsets' terms are sorted at once, with fences between
    the subsets, and each run between two fences is hashed.
    """
    is_set = lambda at: F.getbit(F.get(band, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1
    held = F.filter(terms, lambda w: is_set(_places(w)[0]) & is_set(_places(w)[1]))

    def keys(held: Column) -> Column:
        out, first, shift = [F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda s: F.shiftleft(s.cast("long"), _BELOW))], 0, CLASS_BITS
        for bits, n in LEVELS:
            out.append(_level(held, shift, bits, n, first))
            first, shift = first + n, shift + bits
        return F.sort_array(F.concat(*out))

    def hashed(run: Column) -> Column:
        low = F.lit((1 << _BELOW) - 1)
        fences = F.array_compact(F.transform(run, lambda x, i: F.when(x.bitwiseAND(low) == 0, i)))
        return _bind(F.array_append(fences, F.size(run)), lambda at: F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda s: _run_hash(run, F.get(at, s), F.get(at, s + 1))))

    return _bind(_bind(held, keys), hashed)


def _level(held: Column, shift: int, bits: int, n: int, first: int) -> Column:
    part = lambda w: F.shiftright(w, shift).bitwiseAND(F.lit((1 << bits) - 1))
    inside = held if n == 1 << bits else F.filter(held, lambda w: part(w) < n)
    return F.transform(inside, lambda w: F.shiftleft(part(w) + first, _BELOW).bitwiseOR(F.shiftrightunsigned(w, 64 - _BELOW)).bitwiseOR(F.lit(1)))


def _run_hash(run: Column, low: Column, high: Column) -> Column:
    return F.when(high - low > 1, F.xxhash64(F.slice(run, low + 2, high - low - 1)))


def fingerprint(hashes: Column, terms: Column) -> Column:
    """Text form: 6 hex digits a subset, '-' for a subset without terms; a text with none at all is hashed by all its terms."""
    short = F.transform(hashes, lambda h: F.coalesce(F.substring(F.hex(h.bitwiseAND(F.lit((1 << 24) - 1)).bitwiseOR(F.lit(1 << 24))), 2, 6), F.lit("-")))
    return F.when(F.size(F.array_compact(hashes)) > 0, F.array_join(short, ".")).otherwise(F.concat(F.lit("~"), F.hex(F.xxhash64(F.sort_array(terms)))))


def likeness(a: Column, b: Column, whole_a: Column, whole_b: Column) -> Column:
    """Equal subsets among those that hold a term of either; without any, whether the fingerprints are equal."""
    agree = F.array_compact(F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y).cast("int"))))
    share = _bind(agree, lambda z: F.when(F.size(z) == 0, 0.0).otherwise(1 - F.size(F.array_remove(z, 1)) / F.size(z)))
    return F.when(whole_a == whole_b, 1.0).otherwise(share)


def fingerprints(docs: DataFrame, least: float = 1e-4, most: float = 0.1) -> DataFrame:
    """doc columns with ``fingerprint``: the operator's plain form (nothing but a projection once the band is known)."""
    band = idf_band(docs.select(F.coalesce("text", F.lit("")).alias("text")), least, most)
    rows = docs.select(F.struct("*").alias("row"), term_hashes(F.coalesce("text", F.lit(""))).alias("t"))
    rows = rows.withColumn("h", subset_hashes(F.col("t"), band)).withColumn("fingerprint", fingerprint(F.col("h"), F.col("t")))
    return rows.select("row.*", "fingerprint")


#: Bounds of ranges that are looked through at a time.
FAN = 128


def _cell(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are below a value, found in two steps."""
    if not bounds:
        return F.lit(0)
    below = lambda some: F.size(F.filter(some, lambda b: b < value))
    coarse = below(_literal(bounds[::FAN], "bigint"))
    fine = below(F.slice(_literal(bounds, "bigint"), (coarse - 1) * FAN + 1, F.lit(FAN)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * FAN + fine)


def with_successor(docs: DataFrame, rows_per_range: int = 20_000, cells: int = FAN * FAN) -> tuple[DataFrame, Window]:
    """doc_id, text, spare (whether the row only stands in for a range's successor) and the window of descending ids.

    At most ``cells`` quantiles and two rows a cell reach the driver.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    n = rows.count()
    wanted = max(1, min(rows_per_range, -(-n // max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))), -(-n // cells))
    parts = -(-n // wanted) if n else 1
    found = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else None
    found = found or []
    # an id that is several quantiles gets a cell of its own
    hot = {v - 1 for v, w in zip(found, found[1:]) if v == w and v > -(1 << 63)}
    bounds = sorted({*found, *hot})
    cell = F.when(F.col("doc_id").isNull(), -1).otherwise(_cell(F.col("doc_id"), bounds))
    counted = {r["cell"]: r for r in rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), (F.min("doc_id") == F.max("doc_id")).alias("alone")).collect()}
    # descending ids, then null; cells of one id that hold more than a range are cut by the text's hash
    base, slices, at = [0] * (len(bounds) + 2), [1] * (len(bounds) + 2), 0
    for c in [*range(len(bounds), -1, -1), -1]:
        held = counted.get(c)
        slices[c + 1] = -(-held["n"] // wanted) if held and held["n"] > 2 * wanted and (c == -1 or held["alone"]) else 1
        base[c + 1], at = at, at + slices[c + 1]
    cut = F.element_at(_literal(slices, "int"), cell + 2)
    part = F.least(cut - 1, F.floor((F.col("text_key").cast("double") / float(1 << 64) + 0.5) * cut).cast("int"))
    rows = rows.withColumn("own", F.element_at(_literal(base, "int"), cell + 2) + part)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), F.col("text_key").alias("key")))
    heads = {r["own"]: r["first"] for r in rows.groupBy("own").agg(first.alias("first")).collect()}
    used = sorted(heads)
    above = {r: used[i - 1] for i, r in enumerate(used)}
    ids = _literal([~heads[r]["down"] if r in heads and heads[r]["down"] is not None else None for r in range(at)], "bigint")
    keys = _literal([heads[r]["key"] if r in heads else None for r in range(at)], "bigint")
    to = _literal([above.get(r, 0) for r in range(at)], "int")
    is_head = F.col("doc_id").eqNullSafe(F.element_at(ids, F.col("own") + 1)) & (F.col("text_key") == F.element_at(keys, F.col("own") + 1))
    place = lambda r, spare: F.struct(r.alias("range"), F.lit(spare).alias("spare"))
    places = F.when(is_head, F.array(place(F.col("own"), False), place(F.element_at(to, F.col("own") + 1), True))).otherwise(F.array(place(F.col("own"), False)))
    rows = rows.select("doc_id", "text", F.inline(places))
    return rows, Window.partitionBy("range").orderBy("spare", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))


def fingerprint_edits(docs: DataFrame, least: float = 1e-4, most: float = 0.1) -> DataFrame:
    """Fingerprints of every text and of its edited text (see the module's contract), with their likeness."""
    band = idf_band(docs.select(F.coalesce("text", F.lit("")).alias("text")), least, most)
    rows, down = with_successor(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text")).withColumn("after", F.lead("text").over(down))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring(F.coalesce("after", F.lit("")), F.lit(1), half))
    rows = rows.select("range", "spare", "doc_id", F.xxhash64("text").alias("order"), F.col("n_chars").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), term_hashes(F.col("text")).alias("c"), term_hashes(edited).alias("ec"))
    rows = rows.withColumn("h", subset_hashes(F.col("c"), band)).withColumn("eh", subset_hashes(F.col("ec"), band))
    rows = rows.select("range", "spare", "doc_id", "order", "n_chars", "edited_sha256", "h", "eh", fingerprint(F.col("h"), F.col("c")).alias("fingerprint"), fingerprint(F.col("eh"), F.col("ec")).alias("edited_fingerprint"))
    down = Window.partitionBy("range").orderBy("spare", F.col("doc_id").desc_nulls_last(), "order")
    rows = rows.withColumn("next", F.lead(F.struct("h", "fingerprint")).over(down)).filter(~F.col("spare"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("h"), F.col("eh"), F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("h"), F.col("next.h"), F.col("fingerprint"), F.col("next.fingerprint")).alias("near_next"),
    )


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return fingerprint_edits(documents(spark, sf_dir))
