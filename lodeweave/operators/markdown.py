"""Markdown sectioning: header sections, special blocks, paragraphs, chunks.

The state machine over lines is plain Python and runs in Arrow UDFs; fixed-length chunks are built-in expressions.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTION = "struct<title:string,content:string,start_idx:int,end_idx:int>"
_HEADER = re.compile(r"(#{1,6})\s+(\S.*)")
_ITEM = re.compile(r"(?:[-*+] |\d+\.\s)")
FENCES = ("```", "~~~")
KEEP_LINES = 4


class Section(NamedTuple):
    title: str
    content: str
    start_idx: int
    end_idx: int


def _section(title: str, body: list[str], start: int, end: int) -> Iterator[Section]:
    text = "\n".join(x for x in body if x.strip())
    if text:
        yield Section(title, f"{title}:\n{text}" if title else text, start, end)


def header_sections(text: str) -> list[Section]:
    """Sections under headers that start a line outside fences; titles show the path of headers.

    Text before the first header goes if a header follows; without any header the whole text is one section with an empty title.
    """
    lines = text.split("\n")
    out: list[Section] = []
    path: list[tuple[int, str]] = []
    title, body, start, fenced = "", [], 0, False
    for i, line in enumerate(lines):
        bare = line.strip()
        fence = bare.startswith(FENCES)
        fenced ^= fence
        m = None if fence or fenced or line[:1] != "#" else _HEADER.fullmatch(bare)
        if not m:
            body.append(line)
            continue
        if title:
            out += _section(title, body, start, i)
        level = len(m[1])
        path = [*(h for h in path if h[0] < level), (level, m[2].strip())]
        title, body, start = " > ".join(t for _, t in path), [], i
    if title or not out:
        out += _section(title, body, start, len(lines) - 1)
    return out


def block_end(lines: list[str], at: int) -> int | None:
    """Last line of the fence, table, quote or list that starts at a line; None if none does."""
    if at >= len(lines):
        return None
    first = lines[at].strip()
    if first.startswith(FENCES):
        return next((i for i in range(at + 1, len(lines)) if lines[i].strip().startswith(first[:3])), len(lines) - 1)

    def run(fits) -> int | None:
        end = at
        while end + 1 < len(lines) and fits(end + 1):
            end += 1
        return end if end > at else None

    if "|" in first and not first.startswith(">") and (end := run(lambda i: "|" in lines[i])) is not None:
        return end
    if first.startswith(">"):
        return run(lambda i: not lines[i].strip() or lines[i].strip().startswith(">"))
    if not _ITEM.match(first):
        return None

    def in_list(i: int) -> bool:
        bare = lines[i].strip()
        if not bare:  # an empty line belongs to the list if an item follows
            return i + 1 < len(lines) and bool(_ITEM.match(lines[i + 1].strip()))
        if _ITEM.match(bare) or lines[i][:1].isspace():
            return True
        return not bare.startswith(("#", ">", *FENCES))

    return run(in_list)


def _kind(block: list[str]) -> str:
    text = "\n".join(block)
    if text.strip().startswith(FENCES):
        return "Code Block"
    if "|" in text and not text.startswith(">"):
        return "Table"
    if text.strip().startswith(">"):
        return "Blockquote"
    return "List" if _ITEM.match(text.lstrip()) else "Block"


def _pieces(lines: list[str]) -> Iterator[tuple[int, int, bool]]:
    """(first line, last line, special) of the blocks and paragraphs in order."""
    at, begin = 0, None
    while at < len(lines):
        end = block_end(lines, at)
        if (end is not None or not lines[at].strip()) and begin is not None:
            yield begin, at - 1, False
            begin = None
        if end is not None:
            yield at, end, True
            at = end
        elif lines[at].strip() and begin is None:
            begin = at
        at += 1
    if begin is not None:
        yield begin, len(lines) - 1, False


def fine_sections(text: str, title: str = "", start_idx: int = 0, end_idx: int = 0) -> list[Section]:
    """Paragraphs and special blocks; tables and lists are cut to four lines and '...'."""
    lines = text.split("\n")
    out = []
    for n, (a, b, special) in enumerate(_pieces(lines), 1):
        block = lines[a : b + 1]
        kind = _kind(block) if special else ""
        name = kind or (f"Par. {n}" if title else f"Paragraph {n}")
        content = "\n".join([*block[:KEEP_LINES], "..."] if kind in ("Table", "List") else block)
        out.append(Section(f"{title} - {name}" if title else name, content, start_idx + a, start_idx + b))
    if not out and text.strip():
        out.append(Section(title, text, start_idx, end_idx))
    return out


def trim_blocks(text: str, max_lines: int = 5) -> str:
    """Tables and lists cut to some lines and '...'."""
    lines = text.split("\n")
    out, at = [], 0
    while at < len(lines):
        end = block_end(lines, at)
        block = lines[at : (at if end is None else end) + 1]
        joined = "\n".join(block)
        if end is not None and len(block) > max_lines and (("|" in joined and not joined.strip().startswith(">")) or _ITEM.match(joined.lstrip())):
            block = [*block[:max_lines], "..."]
        out += block
        at += 1 if end is None else end - at + 1
    return "\n".join(out)


def chunk_sections(text: str, size: int = 2000, max_lines: int = 5) -> list[Section]:
    """Chunks of fixed length of the text with trimmed tables and lists."""
    text = trim_blocks(text, max_lines)
    return [Section(f"Chunk {i // size + 1}", text[i : i + size], i, i + size) for i in range(0, len(text), size)]


def hierarchical_sections(text: str) -> list[Section]:
    """Header sections and their fine sections; of equal contents the shortest title stays, untitled ones go."""
    best: dict[str, Section] = {}
    for section in header_sections(text):
        for s in (section, *fine_sections(section.content, section.title, section.start_idx, section.end_idx)):
            key = hashlib.sha256(s.content.encode("utf-8", "surrogatepass")).hexdigest()
            if key not in best or len(s.title) < len(best[key].title):
                best[key] = s
    return [s for s in best.values() if s.title]


_MAKERS = {"headers": header_sections, "fine": fine_sections, "chunks": chunk_sections, "hierarchical": hierarchical_sections}


def sections(kind: str = "hierarchical"):
    """Arrow UDF: text to its sections."""
    make = _MAKERS[kind]

    @F.pandas_udf(f"array<{SECTION}>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [s._asdict() for s in make(t)] if t is not None else None)

    return split


def explode_sections(docs: DataFrame, key: str, text: str, kind: str = "hierarchical") -> DataFrame:
    """(key, pos, title, content, start_idx, end_idx), one row per section."""
    return docs.select(key, F.posexplode(sections(kind)(F.col(text))).alias("pos", "s")).select(key, "pos", "s.*")


def fixed_chunks(text: Column, size: int) -> Column:
    """Chunks of fixed length without trimming, as built-in expressions."""
    n = F.ceil(F.length(text) / size).cast("int")
    one = lambda i: F.struct(F.concat(F.lit("Chunk "), (i + 1).cast("string")).alias("title"), F.substring(text, i * size + 1, F.lit(size)).alias("content"), (i * size).alias("start_idx"), ((i + 1) * size).alias("end_idx"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast(f"array<{SECTION}>"))


def dedup_by_content(rows: DataFrame, content: str, title: str, keys: list[str]) -> DataFrame:
    """One row per content digest: the shortest title, then the least key."""
    best = F.min(F.struct(F.length(title).alias("n"), *keys, F.col(title).alias("t"))).alias("b")
    return rows.groupBy(F.sha2(content, 256).alias("digest")).agg(best, F.count(F.lit(1)).alias("copies")).select("digest", *(F.col(f"b.{k}").alias(k) for k in keys), F.col("b.t").alias(title), "copies")
