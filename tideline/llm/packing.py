"""Packing documents into training sequences by order-preserving dynamic programming.

Documents are taken in the order of their partition. Window cuts may fall at every document end (free) and every
sentence end, or, where neither is near, inside a sentence; a cut's price and the padding it causes are minimised
together. With C(k) the position of cut k and P(k) its price, the best cost up to cut k is

    D(k) = P(k) + size - C(k) + min over i with C(k) - C(i) <= size of (D(i) + C(i)),

a minimum over a sliding window, kept in a monotone queue: one push and at most one pop for each cut.

Each partition is packed by itself in one pass over its rows: no shuffle, memory for a few stretches of tokens. After a
stretch those cuts are placed that every plan of what may still follow shares (the last common ancestor of all cuts
from which a later window may start), which loses nothing against a plan of the whole partition. Where plans don't meet
within PATIENCE stretches, the one whose padding and prices are least is placed but for its last two windows. Only a
partition's last sequence ends early.

Defined cases: a null or empty text holds just the end id. Rows with null or repeated ids are packed like others; of
plans that cost the same the one with later cuts wins. A very long text is packed whole. An empty table gives no rows.
Only doc_id and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common
from . import tokens

SCHEMA = "doc_id long, start long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Prices of cuts in tokens of padding.
SENTENCE_CUT, WORD_CUT = 4, 16
#: Where no sentence ends within size / REACH tokens, sentences may be cut.
REACH = 32
#: Stretches that are held, at most, while plans don't meet.
PATIENCE = 16
#: A last window that would be padded by more than this is split at powers of two, which need no padding.
SPLIT = 64


def cut_points(ends: np.ndarray, sentences: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, prices) of the cuts allowed after documents that end at `ends` and sentences that end at `sentences`;
    the first is 0."""
    reach = max(1, size // REACH)
    known = np.unique(np.concatenate(([0], ends, sentences)))
    gaps = np.diff(known)
    more = (gaps - 1) // reach
    inner = np.repeat(known[:-1], more) + reach * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    points = np.union1d(known, inner)
    prices = np.full(len(points), WORD_CUT)
    prices[np.searchsorted(points, sentences)] = SENTENCE_CUT
    prices[np.searchsorted(points, ends)] = 0
    prices[0] = 0
    return points, prices


class Plan:
    """The cheapest choices of cuts, no two neighbours further apart than size, up to each point that was added."""

    def __init__(self, size: int, start: int = 0) -> None:
        self.size = size
        self.at, self.price, self.best, self.back = [start], [0], [0], [0]
        self.queue = deque([(start, start, 0)])  # (D + C, C, index), values rising

    def add(self, points: list[int], prices: list[int]) -> None:
        at, best, back, queue, size = self.at, self.best, self.back, self.queue, self.size
        k = len(at)
        at += points
        self.price += prices
        for c, price in zip(points, prices, strict=True):
            while c - queue[0][1] > size:
                queue.popleft()
            value, _, before = queue[0]
            d = price + size - c + value
            best.append(d)
            back.append(before)
            while queue and queue[-1][0] >= d + c:
                queue.pop()
            queue.append((d + c, c, k))
            k += 1

    def shared(self) -> int:
        """The last cut that all plans share: later windows start at cuts that are in the queue; going back from all of
        these, the highest first, until one is left."""
        live = {k for _, _, k in self.queue}
        heap = [-k for k in live]
        heapify(heap)
        while len(heap) > 1:
            before = self.back[-heappop(heap)]
            if before not in live:
                live.add(before)
                heappush(heap, -before)
        return -heap[0]

    def chain(self, k: int) -> list[int]:
        """The cuts, as indices from 0 to k, of the cheapest choice up to cut k."""
        out = [k]
        while out[-1]:
            out.append(self.back[out[-1]])
        return out[::-1]

    def forget(self, k: int) -> None:
        """Starts at cut k, which all plans share or which is chosen for all."""
        at, price = self.at[k:], self.price[k:]
        if k == self.shared():
            self.at, self.price, self.best, self.back = at, price, self.best[k:], [max(0, b - k) for b in self.back[k:]]
            self.queue = deque((v, c, i - k) for v, c, i in self.queue)
        else:
            self.__init__(self.size, at[0])
            self.add(at[1:], price[1:])


def windows(points: np.ndarray, prices: np.ndarray, size: int) -> list[int]:
    """The cheapest choice of cuts from 0 to the last point."""
    plan = Plan(size)
    plan.add(points[1:].tolist(), prices[1:].tolist())
    return [plan.at[k] for k in plan.chain(len(plan.at) - 1)]


def split_tail(a: int, b: int, size: int) -> list[int]:
    """Cuts of the last window (a, b]: powers of two off its front while the padding left is over SPLIT."""
    out = []
    while (n := b - a) & (n - 1) and size - n > SPLIT:
        a += 1 << (n.bit_length() - 1)
        out.append(a)
    return [*out, b]


class _Stretch:
    """Tokens that are not yet placed, with the documents that they are of. Positions count from the partition's start."""

    def __init__(self, size: int, ends: np.ndarray, first_sequence: int, stretch: int) -> None:
        self.size, self.is_end, self.sequence, self.stretch = size, ends, first_sequence, stretch
        self.plan = Plan(size)
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # id, tokens in all, tokens placed before
        self.planned = self.n = 0  # arrays of ids that the plan knows; tokens that it doesn't

    def add(self, doc_id: object, ids: np.ndarray) -> Iterator[tuple]:
        """Takes a document; gives the pieces that are placed for good."""
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.n += len(ids)
        if self.n >= self.stretch:
            yield from self.place(last=False)

    def place(self, last: bool) -> Iterator[tuple]:
        """Rows of the windows that no later token changes, or of all if it is the last."""
        plan = self.plan
        if self.n:
            new, known = self.ids[self.planned :], plan.at[-1]
            points, prices = cut_points(np.cumsum([len(x) for x in new]), np.flatnonzero(self.is_end[np.concatenate(new)]) + 1, self.size)
            plan.add((points[1:] + known).tolist(), prices[1:].tolist())
            self.planned, self.n = len(self.ids), 0
        start, k = plan.at[0], len(plan.at) - 1
        if not last:
            k = plan.shared()
            if not k and plan.at[-1] - start >= PATIENCE * self.stretch:
                k = plan.chain(plan.queue[0][2])[-3:][0]
        if not k:
            return
        cuts = [plan.at[i] - start for i in plan.chain(k)]
        if last:
            cuts = [*cuts[:-1], *split_tail(cuts[-2], cuts[-1], self.size)]
        ids = np.concatenate(self.ids)
        ends = np.cumsum([total - done for _, total, done in self.docs])
        starts = np.concatenate(([0], ends[:-1]))
        edges = np.unique(np.concatenate((cuts, ends[ends < cuts[-1]])))
        in_window, in_doc = np.searchsorted(cuts, edges[:-1], side="right") - 1, np.searchsorted(ends, edges[:-1], side="right")
        for a, b, w, d in zip(edges[:-1].tolist(), edges[1:].tolist(), in_window.tolist(), in_doc.tolist(), strict=True):
            doc_id, total, done = self.docs[d]
            yield doc_id, done + a - int(starts[d]), total, self.sequence + w, a - cuts[w], ids[a:b].tobytes()
        self.sequence += len(cuts) - 1
        placed, d = cuts[-1], int(np.searchsorted(ends, cuts[-1], side="right"))
        self.ids, self.planned = [ids[placed:].copy()], 1
        self.docs = self.docs[d:]
        if self.docs and starts[d] < placed:
            doc_id, total, done = self.docs[0]
            self.docs[0] = (doc_id, total, done + placed - int(starts[d]))
        plan.forget(k)


def sentence_ends(encoder: tokens.Encoder) -> np.ndarray:
    """For each id, whether a sentence may end with it."""
    out = np.zeros(encoder.tokenizer.get_vocab_size() + 2, dtype=bool)
    for token, i in encoder.tokenizer.get_vocab().items():
        out[i] = token[-1] in ".!?" or token[-1] == encoder.table[0x0A]
    return out


def pack(docs: DataFrame, size: int = 2048, end_id: int = 1, path: str | None = None, stretch: int = 1 << 18) -> DataFrame:
    """Pieces of documents with their places in sequences of at most `size` ids; each document is followed by end_id.

    One row for each piece: doc_id, start (ids of its document before it), doc_tokens, sequence_id, offset, ids (unsigned
    32-bit little-endian). Every id lies in one piece, and a sequence's pieces follow each other without gaps.
    """
    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokens.encoder(path)
        out = _Stretch(size, sentence_ends(encode), TaskContext.get().partitionId() << 33, stretch)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                for doc_id, ids in zip(part.column(0).to_pylist(), encode([x or "" for x in part.column(1).to_pylist()]), strict=True):
                    yield from _batches(out.add(doc_id, np.concatenate((ids, end))))
        yield from _batches(out.place(last=True))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    if columns := list(zip(*rows, strict=True)):
        kinds = [pa.int64()] * 5 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["doc_id", "start", "doc_tokens", "sequence_id", "offset", "ids"])


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in the place of their ids."""
    return pieces.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
