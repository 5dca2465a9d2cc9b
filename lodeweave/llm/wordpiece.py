"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match-first segmentation of a word needs no backtracking: the vocabulary is a trie, each node has a failure link to the node that
stands for what is left once the longest pieces are popped, and the number of popped pieces is precomputed.  Walking a word's characters once,
adding the popped counts, gives the number of its pieces without building one.

The vocabulary is taken from a public SentencePiece model as it is (nothing is trained): pieces with the word-start mark begin words, pieces
without it continue them.  A word that the vocabulary cannot spell is one unknown token.  Words are runs of characters other than ASCII
white space.  Counts of words are remembered within a task, up to ``REMEMBERED`` words.

Defined results: null and empty texts have 0 words and 0 tokens; words and texts have no length limit; repeated rows are counted each and alike; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, small_batches

START = "▁"
REMEMBERED = 400_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Automaton:
    """Trie with failure links and popped-piece counts for pieces that begin and pieces that continue words."""

    def __init__(self, begin: Iterable[str], inside: Iterable[str]) -> None:
        #: (node << 21 | character) -> node; node 0 begins words, node 1 stands after a piece.
        self.step: dict[int, int] = {}
        self.link = [-1, -1]
        self.pops = [0, 0]
        last = [False, False]
        parents: list[tuple[int, int]] = [(-1, 0), (-1, 0)]
        for root, pieces in ((0, begin), (1, inside)):
            for piece in pieces:
                node = root
                for c in map(ord, piece):
                    key = node << 21 | c
                    to = self.step.get(key)
                    if to is None:
                        to = self.step[key] = len(last)
                        last.append(False)
                        self.link.append(-1)
                        self.pops.append(0)
                        parents.append((node, c))
                    node = to
                if node != root:
                    last[node] = True
        depth = [0, 0]
        for node in range(2, len(last)):
            depth.append(depth[parents[node][0]] + 1)
        for node in sorted(range(2, len(last)), key=depth.__getitem__):
            if last[node]:
                self.link[node], self.pops[node] = 1, 1
                continue
            parent, c = parents[node]
            at, popped = self.link[parent], self.pops[parent]
            while at >= 0 and (to := self.step.get(at << 21 | c)) is None:
                popped += self.pops[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.pops[node] = to, popped

    def count(self, word: str) -> int:
        """Pieces of the greedy longest-match segmentation, or -1 if there is none."""
        step, link, pops = self.step, self.link, self.pops
        node, n = 0, 0
        for c in map(ord, word):
            while (to := step.get(node << 21 | c)) is None:
                n += pops[node]
                node = link[node]
                if node < 0:
                    return -1
            node = to
        while node > 1:
            n += pops[node]
            node = link[node]
            if node < 0:
                return -1
        return n if word else 0


def greedy_count(word: str, begin: set[str], inside: set[str]) -> int:
    """The same by definition, trying every length from the longest down; -1 if there is no piece."""
    at, n = 0, 0
    while at < len(word):
        pieces = inside if at else begin
        to = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if to is None:
            return -1
        at, n = to, n + 1
    return n


def vocabulary(path: str | None = None) -> tuple[list[str], list[str]]:
    """Pieces that begin words (without the mark) and pieces that continue them, of a SentencePiece model."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in pieces if p.startswith(START) and len(p) > 1], [p for p in pieces if START not in p]


def _counter(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*vocabulary(path))
        known: dict[str, int] = {}
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1):
                n = u = 0
                found = _WORD.findall(text.as_py() or "")
                for w in found:
                    k = known.get(w)
                    if k is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        k = known[w] = automaton.count(w)
                    if k < 0:
                        u += 1
                    else:
                        n += k
                words.append(len(found))
                tokens.append(n + u)
                unknown.append(u)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (words, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return run


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown (words that are one unknown token) of every document."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_counter(path), "doc_id long, n_words long, n_tokens long, n_unknown long")


def op6_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents``."""
    return token_counts(documents(spark, sf_dir))
