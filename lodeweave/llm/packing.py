"""Mixture-controlled packing: documents of several sources into windows of target token proportions.

Deficit round-robin over source queues: in each round queue ``s`` may send ``quantum_s`` tokens (a window's length times
its target proportion); the fraction it could not send stays as a deficit for later rounds.  The stream of served tokens is cut
into windows of ``window`` tokens.  Because quanta are fixed-point numbers, a queue has sent exactly
``min(n_s, floor(r * quantum_s))`` tokens before round ``r``: deficits at any window or partition boundary have a closed
form, so every document finds its windows alone, without a sequential pass.  A queue whose quantum is below ``window / 32`` saves its deficit
until a piece of about that length is due, so a rare source is not ground to single tokens.  Documents are cut wherever a round or
window ends; an emptied queue sends nothing and the others close up, so every window but the tail is full, and the
tail is split into sequences whose lengths are powers of two (no padding at all).

Scale: texts are tokenised once; ids are written as 16-bit numbers to the shared folder.  A document's place in its
queue is its offset within an input partition plus the partition's base, a prefix sum over (partition, queue)
totals.  Tokens are never shuffled by key, so a source with a third of all rows is no hot spot.  Only totals by queue
(at most ``max_queues``) reach the driver.  Queues are shared where there are more sources than that: without targets all sources have the same
target per token and share by hash; with targets, sources of like target share (their targets are summed), and all that have none share one.
The work per piece grows with the number of queues, not with the rounds before it.

Defined results: null text is empty and yields the end id alone; a null source is a queue of its own; repeated rows are packed
each, and rows with one id (or none) are told apart by their place in the table alone; texts have no length limit, and runs of white space of any
length take linear time; queues take turns in code point order, null last; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeweave.llm.common import documents, materialize, small_batches

WINDOW = 2048
END_ID = 1
#: Fixed-point bits of a quantum.
BITS = 16
SPECIAL = "<|endoftext|>"
#: White space as the vocabulary's pattern has it, in runs too long for a matcher that goes back.
_BLANKS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{2048,}")

TOKENS = "doc_id long, part int, queue int, local long, n int, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_vocab() -> tuple[str, str]:
    """Paths of the vocabulary (ranks for bulk work, full definition for texts with special strings)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """ids of a text as uint16; both files hold one vocabulary, and the ranks are several times faster to apply."""

    def __init__(self, ranks_path: str, json_path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.full = json_path, None

    def __call__(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.json_path)
            ids = self.full.encode(text, add_special_tokens=False).ids
        else:
            ids = self._plain(text)
        ids.append(END_ID)
        return np.array(ids, dtype="<u2")

    def _plain(self, text: str) -> list[int]:
        """A run of white space begins a piece of the pattern, and its last character belongs to what follows; so both are boundaries."""
        at, ids = 0, []
        for run in _BLANKS.finditer(text):
            begin, end = run.start(), run.end() - (run.end() < len(text))
            ids += self.fast.encode_ordinary(text[at:begin]) + self.fast._encode_single_piece(text[begin:end])
            at = end
        return ids + self.fast.encode_ordinary(text[at:]) if at else self.fast.encode_ordinary(text)


def _tokenizer(paths: tuple[str, str], queue_of: Mapping[str | None, int] | None, rest: int):
    """``queue_of``: queue by source; sources that are not in it have queue ``rest``.  None: sources share ``rest`` queues by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, sent = Encoder(*paths), TaskContext.get().partitionId(), {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            queues = [zlib.crc32(b"-" if s is None else b"=" + s.encode("utf-8", "surrogatepass")) % rest for s in names] if queue_of is None else [queue_of.get(s, rest) for s in names]
            local, counts, blobs = [], [], []
            for queue, text in zip(queues, batch.column(2)):
                ids = encode(text.as_py() or "")
                local.append(at := sent.get(queue, 0))
                sent[queue] = at + len(ids)
                counts.append(len(ids))
                blobs.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(queues), pa.int32()), pa.array(queues, pa.int32()), pa.array(local, pa.int64()), pa.array(counts, pa.int32()), pa.array(blobs, pa.binary())],
                names=["doc_id", "part", "queue", "local", "n", "ids"],
            )

    return run


def quanta(totals: np.ndarray, targets: np.ndarray | None = None, window: int = WINDOW) -> np.ndarray:
    """Fixed-point tokens per round of each queue: its target proportion (default: its share of the supply) of a window."""
    weight = (totals if targets is None else targets).astype(float)
    weight = np.where(totals > 0, np.maximum(weight, 0), 0)
    whole = window << BITS
    q = np.maximum(np.rint(weight / max(weight.sum(), 1e-300) * whole).astype(np.int64), 1)
    if (short := whole - int(q.sum())) and q.max() + short > 0:
        q[q.argmax()] += short
    return q


def units(q: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """log2 of the tokens that a queue sends at once: 1, or about ``window / 32`` where the quantum is smaller than that."""
    bits = max(0, (window // 32).bit_length() - 1)
    return np.where(q < (1 << bits) << BITS, bits, 0)


#: Cells (rounds x queues) that are worked on at a time.
CELLS = 1 << 20


def place(queue: int, a: int, b: int, totals: np.ndarray, q: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where tokens a..b of a queue go: starts within the queue, lengths and positions in the served stream, cut at windows."""
    unit = units(q, window)
    # nothing is sent after a queue's last round; this also keeps the products within 64 bits
    ends = -((-(((totals + (1 << unit) - 1) >> unit << unit) << BITS)) // q)
    u, per_round = int(unit[queue]), int(q[queue])
    if u:  # the round of each unit
        rounds = -((-((np.arange(a >> u, ((b - 1) >> u) + 1, dtype=np.int64) + 1) << (u + BITS))) // per_round) - 1
    else:
        first, last = (-((-(k << BITS)) // per_round) - 1 for k in (a + 1, b))
        rounds = np.arange(first, last + 1, dtype=np.int64)
    los, his, poss = [], [], []
    for some in np.array_split(rounds, -(-len(rounds) * len(q) // CELLS)):
        before, after = (np.minimum((np.minimum(r[:, None], ends) * q) >> (BITS + unit) << unit, totals) for r in (some, some + 1))
        los.append(np.maximum(before[:, queue], a))
        his.append(np.minimum(after[:, queue], b))
        poss.append(after[:, :queue].sum(1) + before[:, queue + 1 :].sum(1) + los[-1])
    lo, hi, pos = map(np.concatenate, (los, his, poss))
    inside = (pos // window + 1) * window  # a piece is at most a window long: at most one window ends inside it
    cut = inside < pos + hi - lo
    if cut.any():  # positions grow with the rounds: split the pieces that a window's end cuts
        lo, pos = np.concatenate([lo, (lo + inside - pos)[cut]]), np.concatenate([pos, inside[cut]])
        order = np.argsort(lo, kind="stable")
        lo, pos = lo[order], pos[order]
    keep = np.append(lo[1:], b) > lo
    lo, pos = lo[keep], pos[keep]
    return lo, np.append(lo[1:], b) - lo, pos


def tail_sequences(total: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ids of the sequences after the last full window: one for each power of two in what remains."""
    at, left, starts = total - total % window, total % window, []
    while left:
        size = 1 << (left.bit_length() - 1)
        starts.append(at)
        at, left = at + size, left - size
    return np.array(starts, np.int64), total // window + np.arange(len(starts), dtype=np.int64)


def _placer(totals: list[int], q: list[int], window: int):
    total = sum(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of, q_of = np.array(totals, np.int64), np.array(q, np.int64)
        starts, seqs = tail_sequences(total, window)
        full = total - total % window
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            row, sums = [], []
            for i, (queue, begin, n, blob) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("queue", "begin", "n", "ids")))):
                lo, length, pos = place(queue, begin, begin + n, n_of, q_of, window)
                if pos[-1] + length[-1] > full:
                    ends = starts[(starts > pos[0]) & (starts < pos[-1] + length[-1])]
                    for e in ends:
                        k = int(np.searchsorted(pos, e, side="right")) - 1
                        if pos[k] < e < pos[k] + length[k]:
                            head = e - pos[k]
                            lo, pos, length = np.insert(lo, k + 1, lo[k] + head), np.insert(pos, k + 1, e), np.insert(length, k + 1, length[k] - head)
                            length[k] = head
                lo = lo - begin
                ids = memoryview(np.frombuffer(blob, "<u2").astype("<u4").tobytes())
                sums += [zlib.crc32(ids[4 * s : 4 * (s + m)]) for s, m in zip(lo.tolist(), length.tolist())]
                seq, offset = pos // window, pos % window
                if len(starts) and pos[-1] >= full:
                    k = np.searchsorted(starts, pos, side="right") - 1
                    seq, offset = np.where(pos >= full, seqs[k], seq), np.where(pos >= full, pos - starts[k], offset)
                row.append(np.full(len(lo), i))
                for column, values in zip(out, (lo, length, np.full(len(lo), n), seq, offset)):
                    column.append(values)
            if row:
                lo, length, n, seq, offset = (pa.array(np.concatenate(c), pa.int64()) for c in out)
                doc = pc.take(batch.column("doc_id"), pa.array(np.concatenate(row)))
                yield pa.RecordBatch.from_arrays([doc, lo, length, pa.array(sums, pa.int64()), n, seq, offset], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def target_queues(targets: Mapping[str | None, float], most: int) -> tuple[dict[str | None, int], list[float]]:
    """Queue by source and target by queue; beyond ``most`` sources, those next to each other in order of target share a queue."""
    names = sorted(targets, key=lambda s: (s is None, s or ""))
    if len(names) <= most:
        return {s: i for i, s in enumerate(names)}, [float(targets[s]) for s in names]
    by_target = sorted(names, key=lambda s: float(targets[s]))
    queue_of = {s: i * most // len(names) for i, s in enumerate(by_target)}
    sums = [0.0] * most
    for s, i in queue_of.items():
        sums[i] += float(targets[s])
    return queue_of, sums


def pack(docs: DataFrame, targets: Mapping[str | None, float] | None = None, window: int = WINDOW, max_queues: int = 4096, vocab: tuple[str, str] | None = None) -> DataFrame:
    """Pack every document; one row per piece (see ``PIECES``).

    ``targets``: wanted token proportion by source (absent sources: 0, served as slowly as possible); None: each source's
    share of all tokens, so that every window has the mixture of the whole.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    wanted: list[float] | None = None
    if targets is not None:
        queue_of, wanted = target_queues(targets, max_queues - 1)
        rest = len(wanted)
        wanted = [*wanted, 0.0]
    else:
        found = [r[0] for r in slim.select("source").distinct().limit(max_queues + 1).collect()]
        queue_of = {s: i for i, s in enumerate(sorted(found, key=lambda s: (s is None, s or "")))} if len(found) <= max_queues else None
        rest = max_queues if queue_of is None else 0
    n_queues = len(wanted) if wanted is not None else max_queues if queue_of is None else max(1, len(queue_of))
    tokens = materialize(slim.mapInArrow(_tokenizer(vocab or default_vocab(), queue_of, rest), TOKENS), "tokens")
    parts = materialize(tokens.groupBy("part", "queue").agg(F.sum("n").alias("sent")).coalesce(8), "token-totals")
    totals = np.zeros(n_queues, np.int64)
    for r in parts.groupBy("queue").agg(F.sum("sent").alias("sent")).collect():
        totals[r["queue"]] = r["sent"]
    q = quanta(totals, None if wanted is None else np.array(wanted), window)
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(parts.select("part", "queue", F.coalesce(F.sum("sent").over(before), F.lit(0)).alias("base")).coalesce(8), "token-bases")
    placed = tokens.join(bases, ["part", "queue"]).select("doc_id", "queue", (F.col("base") + F.col("local")).alias("begin"), "n", "ids")
    return placed.mapInArrow(_placer(totals.tolist(), q.tolist(), window), PIECES)


def op1_mixture_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    return pack(documents(spark, sf_dir))
