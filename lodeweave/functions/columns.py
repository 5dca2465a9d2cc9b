"""Column expressions shared by the operators: text cleaning, identity hashes, RDF term rendering.

Everything here is built-in expressions, so it stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeweave.functions.vocab import BASE, NAMESPACES, PREFIXES


def strip(c: Column) -> Column:
    """Without white space at both ends (any kind, unlike ``trim``)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def last_segment(c: Column, sep: str = "/") -> Column:
    return F.substring_index(c, sep, -1)


def clean_text(c: Column) -> Column:
    """NUL becomes the replacement character (stores reject it)."""
    return F.translate(c, "\u0000", "�")


def json_string(c: Column) -> Column:
    """JSON text of a string with ASCII output, spaced and escaped like Python's default encoder."""

    def escape(ch: Column) -> Column:
        cp = F.ascii(ch)
        hex4 = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
        high = F.shiftright(cp - 0x10000, 10) + 0xD800
        low = (cp - 0x10000).bitwiseAND(F.lit(0x3FF)) + 0xDC00
        out = F.when(ch == '"', F.lit('\\"')).when(ch == "\\", F.lit("\\\\"))
        for raw, text in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
            out = out.when(ch == raw, F.lit(text))
        return out.when((cp >= 32) & (cp < 128), ch).when(cp < 0x10000, hex4(cp)).otherwise(F.concat(hex4(high), hex4(low)))

    plain = F.concat(F.lit('"'), c, F.lit('"'))
    full = F.concat(F.lit('"'), F.array_join(F.transform(F.split(c, ""), escape), ""), F.lit('"'))
    return F.when(c.rlike(r'^[\x20-\x21\x23-\x5B\x5D-\x7E]*$'), plain).otherwise(full)


def entity_json(platform: Column, kind: Column, ident: Column, number: bool = False) -> Column:
    """Canonical JSON of an entity: keys sorted, ``", "`` and ``": "`` as separators."""
    value = ident.cast("string") if number else json_string(ident)
    return F.concat(F.lit('{"id": '), value, F.lit(', "platform": '), json_string(platform), F.lit(', "type": '), json_string(kind), F.lit("}"))


def entity_hash(platform: Column | str, kind: Column | str, ident: Column, number: bool = False) -> Column:
    """Content hash that names an entity (SHA-256 of its canonical JSON)."""
    platform = F.lit(platform) if isinstance(platform, str) else platform
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.sha2(entity_json(platform, kind, ident, number), 256)


def entity_uri(platform: Column | str, kind: Column | str, ident: Column, number: bool = False, base: str = BASE) -> Column:
    return F.concat(F.lit(base), entity_hash(platform, kind, ident, number))


def predicate_uri(prop: Column, base: str = BASE) -> Column:
    """``prefix:name`` to a predicate URI; no colon: in the base namespace; unknown prefix: null."""
    prefix, name = F.lower(F.substring_index(prop, ":", 1)), F.substring(prop, F.instr(prop, ":") + 1, F.length(prop))
    known = F.lit(None).cast("string")
    for given, space in PREFIXES.items():
        known = F.when(prefix == given, F.lit(NAMESPACES[space])).otherwise(known)
    return F.when(F.instr(prop, ":") == 0, F.concat(F.lit(base), prop)).otherwise(F.concat(known, name))


def n3(value: Column, kind: Column, dtype: Column | None = None) -> Column:
    """N3 text of a term: ``kind`` is uri, bnode or literal."""
    body = value
    for raw, text in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        body = F.replace(body, F.lit(raw), F.lit(text))
    literal = F.concat(F.lit('"'), body, F.lit('"'))
    if dtype is not None:
        literal = F.when(dtype.isNotNull(), F.concat(literal, F.lit("^^<"), dtype, F.lit(">"))).otherwise(literal)
    return F.when(kind == "uri", F.concat(F.lit("<"), value, F.lit(">"))).when(kind == "bnode", F.concat(F.lit("_:"), value)).otherwise(literal)


def triple_hash(s: Column, p: Column, o: Column) -> Column:
    """MD5 over the concatenated N3 texts."""
    return F.md5(F.concat(s, p, o))


def info_hash(method: Column, confidence: Column) -> Column:
    """Key of an extraction info: method and confidence, rounded to five places in canonical decimal text."""
    return F.md5(F.concat(method, F.round(confidence, 5).cast("decimal(6,5)").cast("string")))


def drop_first_match(c: Column, pattern: str) -> Column:
    """Text without the first match of a pattern (``regexp_replace`` would take all)."""
    at = F.regexp_instr(c, F.lit(pattern))
    hit = F.regexp_substr(c, F.lit(pattern))
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.substring(c, at + F.length(hit), F.length(c)))).otherwise(c)


def front_matter(card: Column) -> Column:
    """Body of the first front-matter block between two ``---`` lines; '' without one."""
    return F.regexp_extract(card, r"(?ms)^---\s*$(.*?)^---\s*$", 1)


def human_number(c: Column) -> Column:
    """'1.5K' -> 1500; K, M and B scale; no number -> 0."""
    number = F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?)", 1)
    unit = F.upper(F.regexp_extract(c, r"[0-9]+(?:\.[0-9]+)?\s*([KkMmBb])", 1))
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    return F.when(number == "", F.lit(0)).otherwise(F.try_to_number(number, F.lit("999999999999.999999")).cast("double") * scale).cast("long")


def humanize(prop: Column) -> Column:
    """Readable property name: 'fair4ml:intendedUse' -> 'Intended Use'."""
    base = F.regexp_replace(prop, r"^[^:]*:", "")
    return F.initcap(F.replace(F.regexp_replace(base, r"(?<=[a-z])([A-Z])", " $1"), F.lit("_"), F.lit(" ")))


def article_id(c: Column) -> Column:
    """arXiv id: last path part, cut at the version; null unless it holds a dot."""
    ident = F.substring_index(last_segment(strip(c)), "v", 1)
    return F.when(F.contains(c, F.lit(".")), ident)


def informative(value: Column) -> Column:
    """False for the texts that stand for a missing value."""
    v = strip(value)
    return v.isNotNull() & ~v.isin("", "None", "No context to answer the question", "Information not found")


def any_time(c: Column) -> Column:
    """Timestamp of any of the four formats in use, else null."""
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in ("yyyy-MM-dd_HH-mm-ss", "yyyyMMdd_HHmmss", "yyyy-MM-dd'T'HH:mm:ss")]
    cut = F.try_to_timestamp(F.substring_index(F.regexp_replace(c, r"(Z|[+-]\d\d:\d\d)$", ""), ".", 1), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return F.coalesce(*tries, cut)


def epoch_day(seconds: Column) -> Column:
    """Calendar day (UTC, whatever the session's zone) of seconds since 1970: year-month-day, the year of four digits at least and without a sign when it has more."""
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    year = F.year(day).cast("string")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.when(F.year(day).between(0, 999), F.lpad(year, 4, "0")).otherwise(year), F.lit("-"), two(F.month(day)), F.lit("-"), two(F.day(day)))
