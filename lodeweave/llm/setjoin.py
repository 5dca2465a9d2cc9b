"""Exact set-similarity join of token sets by prefix, positional and length filters.

Equal sets are one set from the start.  Tokens are ordered by rarity (then by hash), and two sets of Jaccard similarity
``t`` must share one of their first ``p(n) = n - ceil(t n) + 1`` tokens.  Rarity comes from a table of bounded size that counts the tokens of all
rows by hash; any order that depends on the token alone keeps the join exact, so the table's collisions cost time, never links.

Two sets that share a prefix token meet in the cluster of that token's pivot (the least set that has it), so a set is sent
once per pivot, not once per token, and no pairs are ever listed.  Before anything is sent, sets that cannot have a partner leave: of the first
``p + l - 1`` tokens a similar pair shares at least ``l``, so a set with fewer tokens that some other set has there is alone.

A cluster is joined in memory under its own exact token frequencies: tokens that no other member has go first in the order, so a
member that differs from all others in too many tokens finds no candidate.  Candidates share prefix tokens under this order and under further ones
(the candidate sets are intersected), pass the length filter, and are not connected yet; only then whole sets are compared, and only links that
connect something new leave the task.  Clusters beyond ``block_tokens`` are cut into blocks, and blocks are joined two by two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import if_small, materialize, small_batches
from lodeweave.llm.components import components
from lodeweave.llm.tokensets import TOKEN_MASK, Counter, Lines, Rarity, Shingles, batches, mix, squeeze, unsqueeze

SKETCH_BITS = 20
CHUNK = 1 << 12
#: Odd multipliers of the further token orders.
ORDERS = (0x9E3779B97F4B, 0xC2B2AE3D27D5)
_TABLE = "doc_id long, text_key long, n long, high long, low long, counts binary, chunk int"
_TABLE_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("counts", pa.binary()), ("chunk", pa.int32())])


def prefix_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(n > 0, n - -(-num * n // den) + 1, 0)


def extra_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """``l`` by set size; never falls with the size."""
    return np.maximum(1, prefix_length(n, num, den) // 2)


def rarity_ranks(counters: DataFrame, tables: int, chunk: int) -> np.ndarray:
    """Ranks by cell of ``tables`` count tables (chunk, counts), summed up over all tasks: four steps for each doubling of a count in the first, one in the
    second.

    At most ``tables * 2 ** SKETCH_BITS`` numbers reach the driver.
    """

    def total(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in parts:
            for c, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                values = np.frombuffer(raw, "<u4" if len(raw) == 4 * chunk else "<i8").astype(np.int64)
                held[c] = held[c] + values if c in held else values
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    counts = np.zeros(tables << SKETCH_BITS, np.int64)
    for r in counters.mapInArrow(total, schema).repartition("chunk").mapInArrow(total, schema).collect():
        counts[r["chunk"] * chunk : (r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], "<i8")
    # the bulk of the cells holds only the noise of rare tokens: ranks start at the median
    rank = lambda c, steps: np.clip(np.rint(steps * np.log2(np.maximum(c, 1) / max(1.0, float(np.median(c))))), 0, 63).astype(np.uint8)
    return np.stack([rank(c, steps) for c, steps in zip(counts.reshape(tables, -1), (4, 1))])


def join_members(ids: list[int], sets: list[np.ndarray], num: int, den: int, orders: int, firsts: list[tuple] | None = None) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a cluster: exact, by local token frequencies and intersected prefix filters.

    With ``firsts`` (the places of the sets), instead one link (set, earlier set) for each set that is similar to an earlier one, connected or not.
    """
    places = {t: i for i, t in enumerate(sorted(set(firsts or [])))}
    when = np.array([places[t] for t in firsts], np.int64) if firsts is not None else None
    if len(ids) == 2:
        a, b = sets
        both = len(np.intersect1d(a, b, assume_unique=True))
        if both * den < num * (len(a) + len(b) - both) or (when is not None and when[0] == when[1]):
            return []
        return [(ids[0], ids[1]) if when is None or when[0] > when[1] else (ids[1], ids[0])]
    rank = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    when = None if when is None else when[rank]
    ids, sets = [ids[i] for i in rank], [sets[i] for i in rank]
    size = np.array([len(x) for x in sets], np.int64)
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(ids)), size)
    words, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keys = [df.astype(np.uint64) << np.uint64(32), *((words * np.uint64(m)) & TOKEN_MASK for m in ORDERS[:orders])]
    prefix = prefix_length(size, num, den)
    index = []
    for key in keys:
        place = np.empty(len(words), np.int64)
        place[np.lexsort((words, key))] = np.arange(len(words))
        both = np.sort(owner * len(words) + place[token])
        who, what = both // len(words), both % len(words)
        early = np.arange(len(both)) - first[who] < prefix[who]
        who, what, where = who[early], what[early], (np.arange(len(both)) - first[who])[early]
        by = np.argsort(what, kind="stable")
        posts, where = who[by], where[by]
        begin = np.searchsorted(what[by], what)
        end = np.searchsorted(what[by], what, side="right")
        index.append((posts, where, begin, end, np.cumsum(prefix) - prefix))
    label = np.arange(len(ids))
    late = np.zeros(len(ids), bool)
    has = np.zeros(len(words), bool)
    out = []
    for u in range(1, len(ids)):
        low = int(np.searchsorted(size[:u], -(-num * size[u] // den)))
        if when is None:
            able = label[low:u] != label[u]
        else:  # what is known to have an earlier one needs no other
            able = np.where(when[low:u] < when[u], not late[u], (when[low:u] > when[u]) & ~late[low:u])
        for nth, (posts, where, begin, end, at) in enumerate(index):
            mark, met = np.zeros(u, bool), np.zeros(u, bool)
            for k in range(at[u], at[u] + prefix[u]):
                if end[k] - begin[k] > 1:
                    run = posts[begin[k] : end[k]]
                    run = run[: np.searchsorted(run, u)]
                    if nth:
                        mark[run] = True
                        continue
                    # positional filter, under the first order: no more can be common than what follows the first common token in both
                    new = ~met[run]
                    most = 1 + np.minimum(size[u] - 1 - (k - at[u]), (size[run] - 1 - where[begin[k] : begin[k] + len(run)]))
                    met[run] = True
                    mark[run[new & (most * (num + den) >= num * (size[u] + size[run]))]] = True
            able &= mark[low:]
            if not able.any():
                break
        some = low + np.flatnonzero(able)
        if not len(some):
            continue
        mine = token[first[u] : first[u] + size[u]]
        has[mine] = True
        span = size[some]
        at = np.repeat(first[some] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        both = np.add.reduceat(has[token[at]].astype(np.int64), np.cumsum(span) - span)
        has[mine] = False
        for v in some[both * den >= num * (size[u] + span - both)].tolist():
            if when is not None:
                x, y = (u, v) if when[u] > when[v] else (v, u)
                if not late[x]:
                    out.append((ids[x], ids[y]))
                    late[x] = True
            elif label[v] != label[u]:
                out.append((ids[u], ids[v]))
                label[label == label[v]] = label[u]
    return out


@dataclass
class SetJoin:
    """Join of the token sets of ``docs`` (doc_id, text) at Jaccard similarity ``num / den``.

    ``doubles``: first halves of set names that several sets share (see :meth:`lodeweave.llm.tokensets.Sets.ids`).

    ``orders``: further global token orders under which a pair must share prefix tokens too, before whole sets are compared.
    ``block_tokens``: tokens that a task joins at once.
    ``most_sent``: entries up to which the list of wanted sets is broadcast (some 50 MB); beyond it is joined by a shuffle.
    """

    docs: DataFrame
    kind: Shingles | Lines
    num: int
    den: int
    orders: int = 0
    block_tokens: int = 2_000_000
    most_sent: int = 400_000
    table: DataFrame = field(init=False)
    doubles: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        small_batches(self.docs.sparkSession)
        text = F.col("text").cast("string")
        # rows without an id, or that share one, are told apart by a hash of their text; if it collides, a text is read in vain
        self.docs = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
        written = materialize(self.docs.mapInArrow(self._signer(), _TABLE), "sets")
        named = written.filter("chunk is null").drop("chunk", "counts")
        # sets are named by 128 bits; where two share the first 64, both go by the others (a handful of names at any real size)
        shared = named.groupBy("high").agg((F.min("low") != F.max("low")).alias("several")).filter("several").select("high").collect()
        self.doubles = np.array(sorted(r["high"] for r in shared), np.int64)
        other = F.udf(lambda x: int(mix(np.array([x], np.int64).view(np.uint64)).view(np.int64)[0]), "long")
        set_id = F.when(F.col("high").isin(self.doubles.tolist()), other("low")).otherwise(F.col("high")) if len(self.doubles) else F.col("high")
        self.table = named.select("doc_id", "text_key", "n", set_id.alias("set_id"))
        self._counters = written.filter("chunk is not null").select("chunk", "counts")

    def _signer(self):
        kind = self.kind

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = Counter(2, SKETCH_BITS)  # of tokens, of words
            for part in parts:
                ids, keys = part.column(0), part.column(2)
                for sets in batches(part.column(1), kind):
                    counter.add(sets.tokens, sets.words)
                    k = len(sets.owner)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(sets.owner)), keys.take(pa.array(sets.owner)), pa.array(sets.count, pa.int64()), *map(pa.array, sets.names()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32())],
                        schema=_TABLE_ARROW,
                    )
            counts = counter.total()
            if counter.any:
                rows = counts.astype("<u4").reshape(-1, CHUNK)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(np.arange(len(rows)), pa.int32())], schema=_TABLE_ARROW)

        return run

    def _rarity(self) -> Rarity:
        """What shares a token by chance has frequent words in it, so tokens of rare words come first; tokens counted often go last."""
        return Rarity(*rarity_ranks(self._counters, 2, CHUNK))

    def _prefixes(self) -> DataFrame:
        """token, set_id, n, pos of every distinct set's first p + l - 1 tokens (repeats across tasks remain)."""
        kind, num, den, rarity, doubles = self.kind, self.num, self.den, self._rarity(), self.doubles

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for part in parts:
                for sets in batches(part.column(0), kind, rarity):
                    ids = sets.ids(doubles)
                    fresh = np.zeros(len(ids), bool)
                    for i, s in enumerate(ids.tolist()):
                        if s not in seen:
                            seen.add(s)
                            fresh[i] = True
                    if len(seen) > 500_000:
                        seen.clear()
                    size = np.where(fresh & (sets.count > 0), prefix_length(sets.count, num, den) + extra_length(sets.count, num, den) - 1, 0)
                    item, token = sets.order
                    pos = np.arange(len(item)) - np.searchsorted(item, item)
                    early = pos < size[item]
                    item, token, pos = item[early], token[early], pos[early]
                    cols = [token.astype(np.int64), ids[item], sets.count[item].astype(np.int32), pos.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "set_id", "n", "pos"])

        return self.docs.select("text").mapInArrow(run, "token long, set_id long, n int, pos int")

    def _groups(self) -> DataFrame:
        """set_id, n, pos, pivot of each set that shares a token, by token; the pivot is the group's least set."""

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: tuple | None = None  # token, set, pivot (set, n, pos), whether the pivot has left
            for part in parts:
                token, set_id, n, pos = (part.column(i).to_numpy() for i in range(4))
                if not len(token):
                    continue
                again = np.concatenate([[last is not None and (token[0], set_id[0]) == last[:2]], (token[1:] == token[:-1]) & (set_id[1:] == set_id[:-1])])
                tail = token[-1], set_id[-1]
                token, set_id, n, pos = token[~again], set_id[~again], n[~again], pos[~again]
                if not len(token):
                    continue
                if last is not None and token[0] == last[0] and not last[3]:  # its pivot waits for a second set
                    token, set_id, n, pos = (np.concatenate([[v], c]) for v, c in zip((last[0], *last[2]), (token, set_id, n, pos)))
                first = np.concatenate([[True], token[1:] != token[:-1]])
                begin = np.flatnonzero(first)
                group = np.cumsum(first) - 1
                pivot = set_id[begin]
                shared = np.diff(np.append(begin, len(token))) > 1
                if last is not None and token[0] == last[0] and last[3]:
                    pivot = np.concatenate([[last[2][0]], pivot[1:]])
                    shared[0] = True
                at = begin[-1]
                head = last[2] if last is not None and len(begin) == 1 and last[3] and token[0] == last[0] else (set_id[at], n[at], pos[at])
                last = (*tail, head, bool(shared[-1]))
                keep = shared[group]
                yield pa.RecordBatch.from_arrays([pa.array(set_id[keep], pa.int64()), pa.array(n[keep], pa.int32()), pa.array(pos[keep], pa.int32()), pa.array(pivot[group][keep], pa.int64())], names=["set_id", "n", "pos", "pivot"])

        rows = self._prefixes().repartition("token").sortWithinPartitions("token", "set_id")
        return rows.mapInArrow(run, "set_id long, n int, pos int, pivot long")

    def clusters(self) -> DataFrame:
        """(pivot, set_id, n): the sets that may have a partner, by the pivots they may meet it at."""
        num, den = self.num, self.den
        groups = materialize(self._groups(), "groups")
        smaller = F.ceil(F.col("n") * num / den).cast("int")
        # l of the smallest partner: floor((1 - t) m) + 1 tokens, halved
        need = F.greatest(F.lit(1), F.floor((smaller - F.ceil(smaller * num / den) + 1) / 2))
        able = groups.groupBy("set_id", "n").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= need).select("set_id")
        early = F.col("pos") < F.col("n") - F.ceil(F.col("n") * num / den) + 1
        return groups.filter(early).select("pivot", "set_id", "n").distinct().join(able, "set_id", "left_semi")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links (a, b) that connect all similar sets, and their components (id, component); links inside a component may be left out."""
        links = materialize(self._compared().distinct(), "links")
        return links, materialize(components(links), "components")

    def _compared(self) -> DataFrame:
        """Links (a, b) of all clusters."""
        clusters = materialize(self.clusters(), "clusters")
        sizes = clusters.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"), F.ceil(F.sum("n") / self.block_tokens).cast("int").alias("blocks")).filter("members > 1")
        sizes = if_small(materialize(sizes, "cluster-sizes"), F.lit(0), self.most_sent)
        own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("own"))
        to = lambda i, j: F.struct(F.col("pivot").alias("key"), i.cast("int").alias("i"), j.cast("int").alias("j"))
        places = F.when(F.col("blocks") == 1, F.array(to(F.lit(0), F.lit(0)))).otherwise(F.transform(others, lambda j: to(F.least(F.col("own"), j), F.greatest(F.col("own"), j))))
        wanted = clusters.join(sizes, "pivot").withColumn("own", own).groupBy("set_id").agg(F.flatten(F.collect_list(places)).alias("to"))
        # where a set can be read again: one text that holds it
        home = self.table.filter("n > 0").groupBy("set_id").agg(F.coalesce(F.min("doc_id"), F.min("text_key")).alias("at"))
        asks = F.struct("set_id", "to")
        sends = materialize(wanted.join(home, "set_id").groupBy("at").agg(F.collect_list(asks).alias("sends")), "sends")
        # a table of known size goes to the texts; beyond the bound the texts go to it
        sends = if_small(sends, F.aggregate("sends", F.lit(0), lambda n, s: n + F.size(s["to"])), self.most_sent)
        kind, num, den, orders, doubles = self.kind, self.num, self.den, self.orders, self.doubles

        def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                asked = [{s["set_id"]: s["to"] for s in row} for row in part.column(1).to_pylist()]
                for sets in batches(part.column(0), kind):
                    ids, first = sets.ids(doubles).tolist(), sets.first
                    cols: list[list] = [[] for _ in range(5)]
                    for k, (owner, s) in enumerate(zip(sets.owner.tolist(), ids)):
                        if (to := asked[owner].pop(s, None)) is not None:
                            raw = squeeze(sets.tokens[first[k] : first[k] + sets.count[k]])
                            for t in to:
                                for column, value in zip(cols, (t["key"], t["i"], t["j"], s, raw)):
                                    column.append(value)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["key", "i", "j", "member", "tokens"])

        def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple | None = None
            members: dict[int, np.ndarray] = {}

            def flush() -> pa.RecordBatch:
                found = join_members(list(members), list(members.values()), num, den, orders) if len(members) > 1 else []
                return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

            for part in parts:
                for key, i, j, member, raw in zip(*(part.column(c).to_pylist() for c in range(5))):
                    if held != (key, i, j):
                        yield flush()
                        held, members = (key, i, j), {}
                    members[member] = unsqueeze(raw)
            yield flush()

        sent = self.docs.withColumn("at", F.coalesce("doc_id", "text_key")).join(sends, "at").select("text", "sends").mapInArrow(send, "key long, i int, j int, member long, tokens binary")
        return sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "member").mapInArrow(compare, "a long, b long")
