"""Exact set-similarity join of the lines of all texts.

A line is the set of its words, and words are ordered by rarity.  Two lines of Jaccard similarity ``t`` have most words in common, so each has
only ``p`` words (about a fifth of them at 0.8) that could stand before the first common one.  Of the prefix lengthened to ``p + g`` words, similar lines share
at least ``g + 1``; when these words are dealt to ``g`` parts by hash, some part holds two shared words.  So lines meet at *pairs* of prefix words of
one part: about ``2 p`` keys a line, and strangers, who share single words of middling rarity all the time, rarely share a pair.  ``g`` goes by the
longer line's size class (powers of four); a line within reach of a longer class has keys of both.

All of this is sent as packed columns of numbers, dealt to buckets.  Keys are dealt by the key, with the set's name and size; only what two sets of
fitting sizes share leaves a bucket, dealt by the name.  There it meets the sets' descriptions: sizes and the parities of their hashed words (128
bits; no more bits than words can differ), which, dealt by the key again, tell most of the rest apart.  What is left is joined in memory, cluster by cluster, by :func:`lodeweave.llm.setjoin.join_members`: prefix filter under the cluster's own frequencies, positional
and length filters, Jaccard on whole lines.

Equal lines are one set: within a task by sorting, across tasks by a map-side combined minimum, so a line that a third of all rows hold costs a row or a
few a task.  A set is named by 128 bits.  All places are ``(doc_id, uid, line)`` with ``uid`` a hash of the whole row, so rows that repeat an id, or have
none, are rows of their own, and no text has to be written again to be found again; rows that are equal in all columns are one row until the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lodeweave.llm.common import if_small, materialize, small_batches
from lodeweave.llm.components import components
from lodeweave.llm.setjoin import SKETCH_BITS, join_members, prefix_length, rarity_ranks
from lodeweave.llm.tokensets import Counter, Lines, Rarity, Sets, batches, mix, set_names, squeeze, unsqueeze

#: Bits of a key within its bucket, and of the set's name beside it (with one more: whether the key is one of the set as the shorter of two).
KEY_BITS, NAME_BITS = 32, 47
#: Lines, and keys, that a task holds before it sends them.
LINES_HELD, KEYS_HELD = 200_000, 2_000_000
#: Keys a bucket is meant to hold.
BUCKET_KEYS = 2_000_000
_NONE = np.iinfo(np.int64).min
_LINES = "uid long, line int, doc long, hi long, lo long, n int, bits0 long, bits1 long, again boolean, counts binary, chunk int"
_LINES_ARROW = pa.schema(
    [("uid", pa.int64()), ("line", pa.int32()), ("doc", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int32()), ("bits0", pa.int64()), ("bits1", pa.int64()), ("again", pa.bool_()), ("counts", pa.binary()), ("chunk", pa.int32())]
)
_CHUNK = 1 << 12


def size_class(n: np.ndarray) -> np.ndarray:
    """Powers of four: 0 for sizes 1 to 3, 1 for 4 to 15, ..."""
    return np.searchsorted(4 ** np.arange(1, 31, dtype=np.int64), n, side="right")


def parts_of(k: int, num: int, den: int) -> int:
    """Parts of the lengthened prefix in a size class: about the prefix length in its middle, and fewer than the words that must be common."""
    return max(0, min((den - num) * 2 * 4**k // den, -(-num * 4**k // den) - 1))


def pair_keys(item: np.ndarray, token: np.ndarray, size: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, 64-bit keys, and whether a key lies in the shorter prefix that a set needs as the shorter of two; ``token`` stands in order of rarity
    within ascending ``item``; ``size`` by item.  The longer and the shorter of two similar sets share a key that is one of the shorter's in that sense.
    """
    first = np.cumsum(size) - size
    pos = np.arange(len(item)) - first[item]
    own, reach = size_class(size), size_class(size * den // num)
    as_longer = prefix_length(size, num, den)
    as_shorter = size - -(-2 * num * size // (num + den)) + 1
    whose, keys, roles = [], [], []
    for k in np.unique(np.concatenate([own, reach])).tolist():
        g = parts_of(k, num, den)
        most = np.where(own == k, as_longer + g, np.where(reach == k, as_shorter + g, 0))
        some = np.flatnonzero(pos < most[item])
        who, what, short = item[some], token[some], pos[some] < as_shorter[item[some]] + g
        salt = np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))
        if not g:
            whose.append(who)
            keys.append(mix(what + salt))
            roles.append(short)
            continue
        part = who * g + ((what * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(33)).astype(np.int64) % g
        order = np.sort((part.astype(np.uint64) << np.uint64(28)) | np.arange(len(part), dtype=np.uint64))
        part, at = order >> np.uint64(28), (order & np.uint64((1 << 28) - 1)).astype(np.int64)
        who, what, short = who[at], what[at], short[at]
        for lag in range(1, len(part)):
            both = np.flatnonzero(part[lag:] == part[:-lag])
            if not len(both):
                break
            whose.append(who[both])
            keys.append(mix(what[both] * np.uint64(0xA24BAED4963EE407) + what[both + lag] * np.uint64(0x9FB21C651E98DF25) + salt))
            roles.append(short[both + lag])  # the later of two in order of rarity
    return (np.concatenate(whose), np.concatenate(keys), np.concatenate(roles)) if keys else (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))


def set_parities(sets: Sets) -> np.ndarray:
    """Two longs per non-empty set: for each of 128 cells whether an odd number of tokens is hashed to it."""
    if not len(sets.owner):
        return np.empty((2, 0), np.int64)
    cell = (sets.tokens * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)
    bit, high = np.uint64(1) << (cell & np.uint64(63)), cell >= np.uint64(64)
    return np.stack([np.bitwise_xor.reduceat(np.where(high == h, bit, np.uint64(0)), sets.first) for h in (False, True)]).view(np.int64)


def near_groups(group: np.ndarray, member: np.ndarray, n: np.ndarray, bits: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (group, member): rows that may have a partner in their group, and for each the least member it may be linked with over others.

    Rows are compared with those 1, 2, 3 ... places further in their group, all groups at once.  A pair stays if sizes allow the similarity and the
    parities that differ (at most the tokens that differ) are few enough.
    """
    a = np.arange(len(group))
    root = np.arange(len(group))
    lag = 0
    while len(a):
        lag += 1
        a = a[a + lag < len(group)]
        a = a[group[a] == group[a + lag]]
        i = a[root[a] != root[a + lag]]  # what is connected needs no comparison
        if not len(i):
            continue
        j = i + lag
        x, y = n[i].astype(np.int64), n[j].astype(np.int64)
        may = np.minimum(x, y) * den >= np.maximum(x, y) * num
        may &= np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64) * (num + den) <= (den - num) * (x + y)
        i, j = root[i[may]], root[j[may]]
        while len(i):  # hook the larger root to the smaller, then point everything at its root
            np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
            while (root != root[root]).any():
                root = root[root]
            i, j = root[i], root[j]
            i, j = i[i != j], j[i != j]
    rows = np.flatnonzero(np.bincount(root, minlength=len(group))[root] > 1) if len(group) else np.empty(0, np.int64)
    return rows, member[root[rows]]


#: Sizes are sent as steps of a logarithm.
_STEP = 1.04


def size_steps(n: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.floor(np.log(np.maximum(n, 1)) / np.log(_STEP))).astype(np.uint8)


#: Packed columns: a key with the set's name, role and size; a meeting (key, name); a set (name, words, parities); a set at a key.
KEY, MET, SET, NEAR = ("<u4", "<u4", "<u2", "u1"), ("<u8", "<u4", "<u2"), ("<i8", "<i4", "<i8", "<i8"), ("<u8", "<i8", "<i4", "<i8", "<i8")


def packed(columns: Sequence[np.ndarray], kinds: Sequence[str]) -> bytes:
    return b"".join(c.astype(k).tobytes() for c, k in zip(columns, kinds))


def unpacked(blobs: Sequence[bytes], kinds: Sequence[str]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    parts: list[list[np.ndarray]] = [[np.empty(0, k)] for k in kinds]
    for blob in blobs:
        n, at = len(blob) // sum(widths), 0
        for part, kind, width in zip(parts, kinds, widths):
            part.append(np.frombuffer(blob, kind, n, at))
            at += n * width
    return [np.concatenate(p) for p in parts]


def _whole(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint64) | (right.astype(np.uint64) << np.uint64(32))


class Dealer:
    """Rows held until there are enough of them to be sent, packed by bucket."""

    def __init__(self, kinds: Sequence[str]) -> None:
        self.kinds = kinds
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, bucket: np.ndarray, columns: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Takes rows; gives a batch once KEYS_HELD rows are there."""
        if len(bucket):
            self.held.append((bucket.astype(np.int32), *(c.astype(k) for c, k in zip(columns, self.kinds))))
            self.size += len(bucket)
        if self.size >= KEYS_HELD:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket, *columns = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.size = [], 0
        order = np.argsort(bucket)
        bucket, columns = bucket[order], [c[order] for c in columns]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        blobs = [packed([c[a:b] for c in columns], self.kinds) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array(blobs, pa.binary())], names=["bucket", "data"])


def dealt(parts: Iterator[pa.RecordBatch], kinds: int = 1) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Buckets of rows (bucket, kind, data) that stand together, with their blobs by kind."""
    at, blobs = None, [[] for _ in range(kinds)]
    for part in parts:
        for bucket, kind, blob in zip(*(part.column(c).to_pylist() for c in range(3))):
            if bucket != at:
                if at is not None:
                    yield at, blobs
                at, blobs = bucket, [[] for _ in range(kinds)]
            blobs[kind].append(blob)
    if at is not None:
        yield at, blobs


def meetings(blobs: list[bytes], num: int = 80, den: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Keys and names of a bucket, each once and in order of the key, of the sets that share a key with another set of a fitting size.

    A set stays if it is the longer of two and the other has the key as the shorter, or the other way round.
    """
    key, left, right, size = unpacked(blobs, KEY)
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    some = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    key, order = key[some].astype(np.uint64), order[some]
    name = _whole(left[order], right[order])
    if not len(key):
        return key, name
    size = size[order].astype(np.int64)
    name, short = name & np.uint64((1 << NAME_BITS) - 1), (name >> np.uint64(NAME_BITS)) == 1
    order = np.lexsort((name, key))
    key, name, short, size = key[order], name[order], short[order], size[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
    begin = np.flatnonzero(new)
    key, name, short, size = key[begin], name[begin], np.logical_or.reduceat(short, begin), size[begin]
    # by size within a key, of equal sizes those that have it as the shorter first
    order = np.lexsort((~short, size, key))
    key, name, short, size = key[order], name[order], short[order], size[order]
    reach = int(np.ceil(np.log(den / num) / np.log(_STEP))) + 1
    place = np.arange(len(key))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(short, place, -1))[:-1]])  # the last one before that has it as the shorter
    as_longer = (last >= 0) & (key[last] == key) & ((size - size[last] <= reach) | (size == 255))
    after = np.minimum(place + 1, len(key) - 1)
    as_shorter = short & (after > place) & (key[after] == key) & ((size[after] - size <= reach) | (size[after] == 255))
    some = as_longer | as_shorter
    key, name = key[some], name[some]
    order = np.lexsort((name, key))
    return key[order], name[order]


def key_columns(key: np.ndarray, name: np.ndarray, short: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Columns of ``KEY``."""
    left = (name & np.uint64((1 << NAME_BITS) - 1)) | (short.astype(np.uint64) << np.uint64(NAME_BITS))
    return [key & np.uint64((1 << KEY_BITS) - 1), left & np.uint64((1 << 32) - 1), left >> np.uint64(32), size]


def described(met: list[bytes], sets: list[bytes]) -> list[np.ndarray]:
    """Columns of ``NEAR`` of a bucket's meetings: the sets of each name beside the key (several, should a name stand for several)."""
    at, left, right = unpacked(met, MET)
    high, n, bits0, bits1 = unpacked(sets, SET)
    name = high.view(np.uint64) & np.uint64((1 << NAME_BITS) - 1)
    order = np.lexsort((bits0, high, name))
    high, n, bits0, bits1, name = (x[order] for x in (high, n, bits0, bits1, name))
    new = np.concatenate([[True], (high[1:] != high[:-1]) | (bits0[1:] != bits0[:-1])]) if len(high) else np.empty(0, bool)
    high, n, bits0, bits1, name = (x[new] for x in (high, n, bits0, bits1, name))
    wanted = _whole(left, right)
    lo, hi = np.searchsorted(name, wanted), np.searchsorted(name, wanted, side="right")
    many = hi - lo
    which = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return [np.repeat(at, many), high[which], n[which], bits0[which], bits1[which]]


def near_rows(blobs: list[bytes], num: int, den: int, large: int = 5_000) -> list[np.ndarray]:
    """(pivot, set, words) of a bucket's sets that may be similar to a set they meet; a group too large to compare stays whole."""
    at, high, n, bits0, bits1 = unpacked(blobs, NEAR)
    order = np.lexsort((high, at))
    at, high, n = at[order], high[order], n[order]
    bits = np.stack([bits0, bits1], 1).view(np.uint64)[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(at)))
    huge = np.repeat(size > large, size)
    first = np.repeat(high[begin], size)
    rows, pivot = near_groups(at[~huge], high[~huge], n[~huge], bits[~huge], num, den)
    out = [np.concatenate([pivot, first[huge]]), np.concatenate([high[~huge][rows], high[huge]]), np.concatenate([n[~huge][rows], n[huge]])]
    order = np.lexsort((out[1], out[0]))
    out = [x[order] for x in out]
    new = np.concatenate([[True], (out[0][1:] != out[0][:-1]) | (out[1][1:] != out[1][:-1])]) if len(out[0]) else np.empty(0, bool)
    return [x[new] for x in out]


@dataclass
class LineJoin:
    """Join of the lines of ``docs`` (doc_id, text, and more columns) at Jaccard similarity ``num / den``.

    ``rows``: uid, doc, row.  ``lines``: one row per line with words: uid, line, doc, its set (hi, lo; n words), and whether an earlier
    equal line is known from the same task (``again``).
    ``block_tokens``: tokens that a task joins at once.  ``most_sent``: rows up to which a written table is broadcast (some 50 MB).
    """

    docs: DataFrame
    num: int = 80
    den: int = 100
    block_tokens: int = 500_000
    most_sent: int = 400_000
    rows: DataFrame = field(init=False)
    lines: DataFrame = field(init=False)

    def __post_init__(self) -> None:
        small_batches(self.docs.sparkSession)
        hashed = [F.map_entries(f"`{f.name}`") if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in self.docs.schema]
        at = [F.xxhash64(*hashed).alias("uid"), F.col("doc_id").cast("long").alias("doc")]
        self.rows = self.docs.select(*at, F.struct("*").alias("row"))
        self._texts = self.docs.select(*at, F.col("text").cast("string").alias("text"))
        #: sets with fewer words match equal sets only
        self.least = -(-self.num // max(1, self.den - self.num))
        written = materialize(self._texts.mapInArrow(self._reader(), _LINES), "lines")
        self.lines = written.filter("chunk is null").drop("chunk", "counts")
        self._counters = written.filter("chunk is not null").select("chunk", "counts")

    @staticmethod
    def _reader():
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = Counter(1, SKETCH_BITS)
            held: list[tuple[np.ndarray, ...]] = []

            def flush() -> pa.RecordBatch:
                uid, line, doc, null, hi, lo, n, b0, b1 = (np.concatenate(c) for c in zip(*held))
                held.clear()
                order = np.lexsort((line, uid, doc, ~null, hi, lo))
                uid, line, doc, null, hi, lo, n, b0, b1 = (c[order] for c in (uid, line, doc, null, hi, lo, n, b0, b1))
                again = np.concatenate([[False], (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1])])
                once = np.concatenate([[True], ~again[1:] | (uid[1:] != uid[:-1]) | (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])])  # not the same line of an equal row
                # the first of a set and its repeats in equal rows stand side by side
                uid, line, doc, null, hi, lo, n, b0, b1, again = (c[once] for c in (uid, line, doc, null, hi, lo, n, b0, b1, again))
                cols = [pa.array(uid), pa.array(line, pa.int32()), pa.array(doc, mask=null), pa.array(hi), pa.array(lo), pa.array(n, pa.int32()), pa.array(b0), pa.array(b1), pa.array(again)]
                return pa.RecordBatch.from_arrays([*cols, pa.nulls(len(uid), pa.binary()), pa.nulls(len(uid), pa.int32())], schema=_LINES_ARROW)

            for part in parts:
                uids = part.column(0).to_numpy()
                null = np.asarray(part.column(1).is_null())
                docs = part.column(1).fill_null(_NONE).to_numpy()
                for sets in batches(part.column(2), Lines()):
                    counter.add(sets.words)
                    held.append((uids[sets.owner], sets.line, docs[sets.owner], null[sets.owner], *set_names(sets), sets.count, *set_parities(sets)))
                    if sum(len(h[0]) for h in held) >= LINES_HELD:
                        yield flush()
            if held:
                yield flush()
            counts = counter.total()
            if counter.any:
                rows = counts.astype("<u4").reshape(-1, _CHUNK)
                none = pa.nulls(len(rows), pa.int64())
                empty = [none.cast(f.type) for f in list(_LINES_ARROW)[:-2]]
                yield pa.RecordBatch.from_arrays([*empty, pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(np.arange(len(rows)), pa.int32())], schema=_LINES_ARROW)

        return run

    def _keys(self, buckets: int, rarity: Rarity) -> DataFrame:
        """bucket, data: keys of the lines' sets, each set once or a few times a task."""
        num, den, least = self.num, self.den, self.least

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dealer, seen = Dealer(KEY), set()
            for part in parts:
                for sets in batches(part.column(0), Lines(), rarity):
                    names = set_names(sets, 1)[0]
                    fresh = np.zeros(len(names), bool)
                    for i in np.flatnonzero(sets.count >= least).tolist():
                        if (name := int(names[i])) not in seen:
                            seen.add(name)
                            fresh[i] = True
                    if len(seen) > LINES_HELD:
                        seen.clear()
                    item, token = sets.order
                    early = fresh[item]
                    item, token = item[early], token[early]
                    who, key, short = pair_keys(item, token, _counted(item, sets.count, fresh), num, den)
                    yield from dealer.add((key >> np.uint64(KEY_BITS)) % np.uint64(buckets), key_columns(key, names[who].view(np.uint64), short, size_steps(sets.count)[who]))
            yield from dealer.rest()

        return self._texts.select("text").mapInArrow(run, "bucket int, data binary")

    def _rarity(self) -> Rarity:
        ranks = rarity_ranks(self._counters, 1, _CHUNK)[0]
        return Rarity(ranks, ranks)

    def _near(self) -> DataFrame:
        """(pivot, num, n): sets (by the first half of their names) that may be similar to a set they share a key with, by the groups' least sets."""
        words = self.lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        partitions = max(1, int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        buckets = max(4 * partitions, words // 2 // BUCKET_KEYS)
        num, den = self.num, self.den
        packs = "bucket int, data binary"

        def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dealer = Dealer(MET)
            for bucket, (blobs,) in dealt(parts):
                key, name = meetings(blobs, num, den)
                yield from dealer.add(name % np.uint64(buckets), [key | (np.uint64(bucket) << np.uint64(KEY_BITS)), name & np.uint64((1 << 32) - 1), name >> np.uint64(32)])
            yield from dealer.rest()

        def describe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dealer = Dealer(SET)
            for part in parts:
                high, *rest = (part.column(c).to_numpy() for c in range(4))
                yield from dealer.add((high.view(np.uint64) & np.uint64((1 << NAME_BITS) - 1)) % np.uint64(buckets), [high, *rest])
            yield from dealer.rest()

        def match(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dealer = Dealer(NEAR)
            for _, (sets, met) in dealt(parts, 2):
                if met:
                    columns = described(met, sets)
                    yield from dealer.add((columns[0] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets), columns)
            yield from dealer.rest()

        def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, (blobs,) in dealt(parts):
                yield pa.RecordBatch.from_arrays(list(map(pa.array, near_rows(blobs, num, den))), names=["pivot", "num", "n"])

        def to_buckets(rows: DataFrame) -> DataFrame:
            rows = rows if "kind" in rows.columns else rows.withColumn("kind", F.lit(0))
            return rows.select("bucket", "kind", "data").repartition(max(partitions, buckets // 4), "bucket").sortWithinPartitions("bucket", "kind")

        met = to_buckets(self._keys(buckets, self._rarity())).mapInArrow(meet, packs)
        sets = self.lines.filter(f"not again and n >= {self.least}").select("hi", "n", "bits0", "bits1").mapInArrow(describe, packs)
        both = sets.withColumn("kind", F.lit(0)).unionByName(met.withColumn("kind", F.lit(1)))
        return to_buckets(to_buckets(both).mapInArrow(match, packs)).mapInArrow(compare, "pivot long, num long, n int")

    def _compared(self, order: bool) -> tuple[DataFrame, DataFrame]:
        """Homes (num, hi, lo, first place of each set that meets others) and links (a, b) by num; with ``order`` those of :func:`join_members` with places."""
        near = materialize(self._near().distinct(), "near")
        # sets that meet at several pivots meet once: at the component of all these meetings
        meet = materialize(components(near.select(F.col("num").alias("a"), F.col("pivot").alias("b"))), "clusters")
        clusters = materialize(meet.join(near.select(F.col("num").alias("id"), "n").distinct(), "id").select(F.col("component").alias("pivot"), F.col("id").alias("hi"), "n"), "members")
        sizes = materialize(clusters.groupBy("pivot").agg(F.ceil(F.sum("n") / self.block_tokens).cast("int").alias("blocks")), "cluster-sizes")
        own = F.pmod(F.xxhash64("hi"), F.col("blocks")).cast("int")
        to = lambda i, j: F.struct(F.col("pivot").alias("key"), i.cast("int").alias("i"), j.cast("int").alias("j"))
        others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("own"))
        places = F.when(F.col("blocks") == 1, F.array(to(F.lit(0), F.lit(0)))).otherwise(F.transform(others, lambda j: to(F.least(F.col("own"), j), F.greatest(F.col("own"), j))))
        wanted = clusters.join(if_small(sizes, F.lit(0), self.most_sent), "pivot").withColumn("own", own).groupBy("hi").agg(F.flatten(F.collect_list(places)).alias("to"))
        wanted = materialize(wanted, "wanted")
        # the first place of each of these sets; half a name may stand for several sets, each is one here
        small = if_small(wanted, F.size("to"), self.most_sent)
        once = self.lines.filter("not again").join(small.select("hi"), "hi", "left_semi")
        homes = once.groupBy("hi", "lo").agg(F.min(F.struct("doc", "uid", "line")).alias("first")).withColumn("num", F.monotonically_increasing_id())
        homes = materialize(homes, "homes")
        asks = homes.join(small, "hi").select(F.col("first.uid").alias("at"), F.struct("num", "to", F.col("first.doc").alias("doc"), F.col("first.line").alias("line")).alias("ask"))
        sends = materialize(asks.groupBy("at", F.col("ask.doc").alias("at_doc")).agg(F.collect_list("ask").alias("sends")), "sends")
        sends = if_small(sends, F.aggregate("sends", F.lit(0), lambda n, s: n + F.size(s["to"])), self.most_sent)
        num, den = self.num, self.den

        def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[tuple] = set()  # equal rows: one of them answers for the task
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
            for part in parts:
                asked, lines = [], []
                for uid, text, row in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                    if (uid, row[0]["doc"]) in done:
                        continue
                    done.add((uid, row[0]["doc"]))
                    if len(done) > 500_000:
                        done.clear()
                    split = text.as_py().split("\n")
                    asked += [(uid, ask) for ask in row]
                    lines += [split[ask["line"]] for ask in row]
                for sets in batches(pa.array(lines, pa.string()), Lines()):
                    cols: list[list] = [[] for _ in types]
                    for owner, first, count in zip(sets.owner.tolist(), sets.first.tolist(), sets.count.tolist()):
                        uid, ask = asked[owner]
                        raw = squeeze(sets.tokens[first : first + count])
                        for t in ask["to"]:
                            for column, value in zip(cols, (t["key"], t["i"], t["j"], ask["num"], raw, ask["doc"], uid, ask["line"])):
                                column.append(value)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["key", "i", "j", "member", "tokens", "doc", "uid", "line"])

        def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple | None = None
            members: dict[int, np.ndarray] = {}
            firsts: dict[int, tuple] = {}

            def flush() -> pa.RecordBatch:
                found = join_members(list(members), list(members.values()), num, den, 0, list(firsts.values()) if order else None) if len(members) > 1 else []
                return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

            for part in parts:
                for key, i, j, member, raw, doc, uid, line in zip(*(part.column(c).to_pylist() for c in range(8))):
                    if held != (key, i, j):
                        yield flush()
                        held, members, firsts = (key, i, j), {}, {}
                    members[member] = unsqueeze(raw)
                    firsts[member] = (doc is not None, doc or 0, uid, line)
            yield flush()

        sent = self._texts.join(sends, (F.col("uid") == F.col("at")) & F.col("doc").eqNullSafe(F.col("at_doc"))).select("uid", "text", "sends").mapInArrow(send, "key long, i int, j int, member long, tokens binary, doc long, uid long, line int")
        links = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "member").mapInArrow(compare, "a long, b long")
        return homes, materialize(links.distinct(), "links")

    def _copies(self) -> DataFrame:
        """hi, lo, first place, of every set that several tasks hold."""
        place = F.struct("doc", "uid", "line")
        return self.lines.filter("not again").groupBy("hi", "lo").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1").drop("held")

    def removed(self) -> DataFrame:
        """(uid, doc, line) of every line that has a similar line at an earlier place (equal rows are one here)."""
        homes, links = self._compared(order=True)
        late = homes.join(links.select(F.col("a").alias("num")).distinct(), "num", "left_semi").select("hi", "lo", F.lit(True).alias("late"))
        marks = self._copies().join(late, ["hi", "lo"], "full").select("hi", "lo", "first", F.coalesce("late", F.lit(False)).alias("late"))
        marks = materialize(marks, "marks")
        found = self.lines.filter("not again").join(if_small(marks, F.lit(0), self.most_sent), ["hi", "lo"])
        found = found.filter(F.col("late") | ~F.struct("doc", "uid", "line").eqNullSafe(F.col("first"))).select("uid", "doc", "line")
        return found.unionByName(self.lines.filter("again").select("uid", "doc", "line"))

    def repeated(self) -> DataFrame:
        """(uid, doc) of rows that stand in the table more than once, equal in all columns."""
        return materialize(self.rows.groupBy("uid", "doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated")

    def classes(self) -> DataFrame:
        """uid, doc, line, top (place of the first line of its connected component of matches) of every line with words."""
        homes, links = self._compared(order=False)
        component = components(links).withColumnRenamed("id", "num")
        linked = homes.join(component, "num").select("hi", "lo", "first", "component")
        tops = linked.groupBy("component").agg(F.min("first").alias("top"))
        tops = linked.join(tops, "component").select("hi", "lo", "top")
        firsts = self.lines.groupBy("hi", "lo").agg(F.min(F.struct("doc", "uid", "line")).alias("first"))
        tops = materialize(firsts.join(tops, ["hi", "lo"], "left").select("hi", "lo", F.coalesce("top", "first").alias("top")), "tops")
        return self.lines.join(tops, ["hi", "lo"]).select("uid", "doc", "line", "top")


def _counted(item: np.ndarray, count: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Sizes by item, 0 for items that are not kept (they have no rows in ``item``)."""
    return np.where(kept, np.bincount(item, minlength=len(count)), 0)
