"""Vectorised token sets of texts: word shingles of a document, or words of each line.

Works on the bytes of an Arrow column, a bounded number of bytes at a time.  A word is a run of bytes other than ASCII white
space, with A-Z lower-cased; it is hashed from its bytes alone, and tokens are 48-bit numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time (a longer text is cut between words).
PIECE = 1 << 20
#: Bytes of a word beyond which it is hashed by itself.
LONG = 64
TOKEN_BITS = 48
TOKEN_MASK = np.uint64((1 << TOKEN_BITS) - 1)
RANK_BITS = 6
_MAX_ITEMS = 1 << (64 - TOKEN_BITS)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_rng = np.random.Generator(np.random.PCG64(20_240_917))
_STEP = int(_rng.integers(1, 1 << 63, dtype=np.uint64)) | 1
_PLACE = [int(x) | 1 for x in _rng.integers(1, 1 << 63, 64, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _lower(x: np.ndarray) -> np.ndarray:
    """A-Z of the eight bytes of each number in lower case."""
    low = x & np.uint64(0x7F7F7F7F7F7F7F7F)
    upper = ((low + np.uint64(0x3F3F3F3F3F3F3F3F)) ^ (low + np.uint64(0x2525252525252525))) & ~x & np.uint64(0x8080808080808080)
    return x | (upper >> np.uint64(2))


def word_hashes(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words of ``data`` (uint8); ``firsts``: offsets where texts begin.

    All words are read eight bytes at a time, together; the few beyond ``LONG`` bytes one by one.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    solid = (data > 32) | (data < 9) | ((data > 13) & (data < 32))
    edge = np.zeros(len(data) + 1, bool)
    edge[firsts] = True
    edge[0] = edge[-1] = True
    begins, ends = solid & edge[:-1], solid & edge[1:]
    begins[1:] |= solid[1:] & ~solid[:-1]
    ends[:-1] |= solid[:-1] & ~solid[1:]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    length = stop - start
    eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).data, strides=(1,))
    out = np.zeros(len(start), np.uint64)
    open_ = np.flatnonzero(length <= LONG)
    for at in range(0, LONG, 8):
        left = length[open_] - at
        x = eight[start[open_] + at] & _MASKS[np.minimum(left, 8)]
        h = (out[open_] ^ _lower(x)) * np.uint64(_STEP)
        out[open_] = h ^ (h >> np.uint64(29))
        open_ = open_[left > 8]
        if not len(open_):
            break
    for i in np.flatnonzero(length > LONG).tolist():
        word = data[start[i] : stop[i]].tobytes().lower()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mix(out + length.astype(np.uint64)), start


@dataclass
class Sets:
    """Token sets of some items: ``tokens`` sorted within items, ``item`` numbers ascending."""

    owner: np.ndarray  #: row of the batch by item
    line: np.ndarray  #: line number by item (0 for whole texts)
    count: np.ndarray  #: distinct tokens by item
    tokens: np.ndarray
    item: np.ndarray
    words: np.ndarray | None = None  #: hashes of all words, in text order
    order: tuple[np.ndarray, np.ndarray] | None = None  #: items and keys by rarity, if a Rarity was given

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.count) - self.count

    def names(self, halves: int = 2) -> np.ndarray:
        """128-bit names as two rows of longs (or the first of them); 0 for the empty set."""
        some = self.count > 0
        out = np.zeros((halves, len(self.owner)), np.int64)
        if some.any():
            out[:, some] = set_names(Sets(self.owner[some], self.line[some], self.count[some], self.tokens, self.item), halves)
        return out

    def ids(self, doubles: np.ndarray | None = None) -> np.ndarray:
        """64-bit identity: the first half of a name, or what its other half gives if the first is one of ``doubles``, which several sets share."""
        high, low = self.names()
        if doubles is None or not len(doubles):
            return high
        return np.where(np.isin(high, doubles), mix(low.view(np.uint64)).view(np.int64), high)


def set_names(sets: Sets, halves: int = 2) -> np.ndarray:
    """128-bit names of non-empty sets, as two rows of longs (or the first of them)."""
    if not len(sets.owner):
        return np.empty((halves, 0), np.int64)
    sums = (np.add.reduceat(mix(sets.tokens * np.uint64(m) + np.uint64(1)), sets.first) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[:halves])
    return np.stack([mix(x + sets.count.astype(np.uint64)) for x in sums]).view(np.int64)


@dataclass
class Rarity:
    """Bounded tables that order tokens by rarity: rank of a token's own count, and of the counts of the words it is made of, by hash cell."""

    tokens: np.ndarray
    words: np.ndarray

    def of(self, tokens: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """Rank of tokens, given the summed ranks of their words; at most RANK_BITS bits."""
        return np.minimum(self.tokens[_cell(tokens, self.tokens)].astype(np.int64) + words, (1 << RANK_BITS) - 1)

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return self.words[_cell(hashes, self.words)].astype(np.int64)


def _cell(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(len(table) - 1)).astype(np.int64)


def _order(item: np.ndarray, tokens: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items and distinct keys (rank, then hash) in ascending order within items."""
    key = (rank.astype(np.uint64) << np.uint64(TOKEN_BITS - RANK_BITS)) | ((tokens & TOKEN_MASK) >> np.uint64(RANK_BITS))
    both = np.sort((item.astype(np.uint64) << np.uint64(TOKEN_BITS)) | key)
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return (both >> np.uint64(TOKEN_BITS)).astype(np.int64), both & TOKEN_MASK


def _gather(owner: np.ndarray, line: np.ndarray, tokens: np.ndarray, item: np.ndarray) -> Sets:
    both = np.sort((item.astype(np.uint64) << np.uint64(TOKEN_BITS)) | (tokens & TOKEN_MASK))
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    item = (both >> np.uint64(TOKEN_BITS)).astype(np.int64)
    return Sets(owner, line, np.bincount(item, minlength=len(owner)), both & TOKEN_MASK, item)


@dataclass(frozen=True)
class Shingles:
    """One item a text: its distinct ``words``-word shingles; a shorter text is one shingle, a text without words none."""

    words: int

    def sets(self, hashes: np.ndarray, owner: np.ndarray, line: np.ndarray, texts: np.ndarray, rarity: Rarity | None = None) -> Sets:
        k = self.words
        place = np.searchsorted(texts, owner)
        n = np.bincount(place, minlength=len(texts))
        parts, items, ranks = [], [], []
        by_word = np.zeros(len(hashes), np.int64) if rarity is None else rarity.of_words(hashes)
        if len(hashes) >= k:
            whole = owner[: len(owner) - k + 1] == owner[k - 1 :]
            x, y = np.zeros(len(hashes) - k + 1, np.uint64), np.zeros(len(hashes) - k + 1, np.int64)
            for j in range(k):
                x += hashes[j : len(hashes) - k + 1 + j] * np.uint64(_PLACE[j])
                y += by_word[j : len(hashes) - k + 1 + j]
            parts.append(mix(x[whole]))
            ranks.append(y[whole])
            items.append(place[: len(owner) - k + 1][whole])
        if (short := np.flatnonzero((n > 0) & (n < k))).size:
            begin = np.searchsorted(place, short)
            x = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = n[short] > j
                x[has] += hashes[begin[has] + j] * np.uint64(_PLACE[j])
            parts.append(mix(x + n[short].astype(np.uint64)))
            items.append(short)
            ranks.append(np.zeros(len(short), np.int64))
        tokens, item = (np.concatenate(parts), np.concatenate(items)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        out = _gather(texts, np.zeros(len(texts), np.int64), tokens, item)
        out.words = hashes
        if rarity is not None:
            out.order = _order(item, tokens, rarity.of(tokens, np.concatenate(ranks) if ranks else np.empty(0, np.int64)))
        return out


@dataclass(frozen=True)
class Lines:
    """One item a line that has words: its distinct words."""

    def sets(self, hashes: np.ndarray, owner: np.ndarray, line: np.ndarray, texts: np.ndarray, rarity: Rarity | None = None) -> Sets:
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (line[1:] != line[:-1])]) if len(hashes) else np.empty(0, bool)
        item = np.cumsum(new) - 1
        out = _gather(owner[new], line[new], hashes, item)
        out.words = hashes
        if rarity is not None:
            out.order = _order(item, hashes, rarity.of(hashes, 0))
        return out


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about PIECE bytes (one row at least) and fewer than _MAX_ITEMS rows."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        base = ends[at] - sizes[at]
        to = max(at + 1, min(int(np.searchsorted(ends, base + PIECE, side="right")), at + _MAX_ITEMS - 1))
        yield at, to
        at = to


def _spread(cuts: np.ndarray, n: int) -> np.ndarray:
    """For each of n places how many of the ascending cuts are at it or before."""
    return np.repeat(np.arange(len(cuts) + 1), np.diff(np.concatenate([[0], cuts, [n]])))


def batches(texts: pa.Array, kind: Shingles | Lines, rarity: Rarity | None = None) -> Iterator[Sets]:
    """Token sets of a column of texts (null: empty), a bounded number of items at a time; every item comes whole and once."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    for a, b in _groups(np.diff(offsets)):
        hashes, owner, line = [], [], []
        # one long text: cut between words
        cuts = [int(offsets[a])]
        while int(offsets[b]) - cuts[-1] > 2 * PIECE:
            part = data[cuts[-1] + PIECE : int(offsets[b])]
            size = 1 << 16
            while not (gap := np.flatnonzero(_SPACE[part[:size]])).size and size < len(part):
                size *= 2
            if not gap.size:
                break
            cuts.append(cuts[-1] + PIECE + int(gap[0]))
        cuts.append(int(offsets[b]))
        lines_before = 0
        for lo, hi in zip(cuts, cuts[1:]):
            part = data[lo:hi]
            firsts = offsets[a:b][(offsets[a:b] >= lo) & (offsets[a:b] < hi)] - lo
            h, start = word_hashes(part, firsts)
            hashes.append(h)
            owner.append(_spread(np.searchsorted(start + lo, offsets[a : b + 1]), len(start)) - 1 + a)
            breaks = np.flatnonzero(part == 10)
            line.append(_spread(np.searchsorted(start, breaks), len(start)) + lines_before)
            lines_before += len(breaks)
        h, owner_, line_ = np.concatenate(hashes), np.concatenate(owner), np.concatenate(line)
        # line numbers within the text
        breaks_before = np.zeros(b - a + 1, np.int64)
        whole = data[offsets[a] : offsets[b]]
        breaks_before[:-1] = np.searchsorted(np.flatnonzero(whole == 10), offsets[a:b] - offsets[a])
        line_ = line_ - breaks_before[owner_ - a]
        if isinstance(kind, Shingles):
            yield kind.sets(h, owner_, line_, np.arange(a, b), rarity)
            continue
        # lines: fewer than _MAX_ITEMS at a time
        new = np.flatnonzero(np.concatenate([[True], (owner_[1:] != owner_[:-1]) | (line_[1:] != line_[:-1])])) if len(h) else np.empty(0, np.int64)
        for at in range(0, len(new), _MAX_ITEMS - 1):
            lo = new[at]
            hi = new[at + _MAX_ITEMS - 1] if at + _MAX_ITEMS - 1 < len(new) else len(h)
            yield kind.sets(h[lo:hi], owner_[lo:hi], line_[lo:hi], np.empty(0, np.int64), rarity)


class Counter:
    """Counts of hashes by cell, in tables of one size; hashes are held until there are enough of them to be worth a pass over a table."""

    def __init__(self, tables: int, bits: int) -> None:
        self.counts = np.zeros((tables, 1 << bits), np.int64)
        self.held: list[list[np.ndarray]] = [[] for _ in range(tables)]
        self.size = 0
        self.any = False

    def add(self, *hashes: np.ndarray) -> None:
        for held, x in zip(self.held, hashes):
            held.append((x & np.uint64(self.counts.shape[1] - 1)).astype(np.int32))
            self.size += len(x)
        if self.size > 1 << 21:
            self.total()

    def total(self) -> np.ndarray:
        for row, held in zip(self.counts, self.held):
            if held:
                row += np.bincount(np.concatenate(held), minlength=len(row))
                held.clear()
        self.any, self.size = self.any or self.size > 0, 0
        return self.counts


def squeeze(tokens: np.ndarray) -> bytes:
    """Six bytes a token."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unsqueeze(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")
