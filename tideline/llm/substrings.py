"""Removal of word runs that stand earlier, found by difference-cover anchors.

A difference cover D of period v holds, for any two positions i and j, a shift s < v with i + s and j + s both in D
(modulo v). So two equal windows of n words share an anchor of n - v + 1 words at such a shift, and hashing anchors at
cover positions alone (4 of 13) finds every match. Words at shared anchors are then extended to whole windows of n words,
and each window but the earliest of its kind marks its words. Windows are told apart by two hashes of 64 and 32 bits,
sums of differently mixed words with different multipliers, so that neither follows from the other: among 1e13 windows
fewer than one pair in a thousand runs is taken for equal by chance.

Two exchanges carry columns of numbers in binary blocks by hash range, one of anchors and one of windows. Before each,
a task keeps one entry of a hash for each stretch of its rows (the earliest), so a passage that a third of all
documents share costs one entry a stretch, and no task sees all its places. A range is merged in pieces, of which a task
keeps one entry of a hash, so a passage in every stretch takes a line of memory. Texts meet their marks by row key, which
is even. Nothing is collected.

Order: doc_id (null first), then among rows of equal ids the order of the rows. Defined cases: a null text has no words;
texts shorter than n words lose none; of repeated rows the first counts as earlier; empty tables give no rows; very long
texts and words are taken whole, in runs of bounded size where many texts meet. Only doc_id and text are read, so other
columns clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common

#: Entries that a task gathers before it sends them; bounds its memory.
STRETCH = 1 << 18
#: Bytes of input for each hash range, by the optimiser's estimate.
RANGE_BYTES = 16 << 20
_NO_ID = -(1 << 63)


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set whose differences are all residues of the period (found by search; periods are small)."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(period)


def ranges(df: DataFrame, size: int = RANGE_BYTES) -> int:
    """Number of hash ranges: it follows the input, so that one range stays small at any size. Where the optimiser knows
    no size (rows from the driver), the number of shuffle partitions."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(common.partitions(df.sparkSession), estimate // size if estimate < 1 << 58 else 0)


def _by_range(hashes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(range, indices in the order given) of hashes by their upper half."""
    place = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(place, kind="stable")
    edges = np.flatnonzero(np.diff(place[order])) + 1
    for part in np.split(order, edges):
        if len(part):
            yield int(place[part[0]]), part


BLOCK_SCHEMA = "range int, data binary"
_MARK = np.dtype([("rid", "<i8"), ("at", "<u4")])


def _home(rids: np.ndarray, n: int) -> np.ndarray:
    """The range in which a row's marks are brought together."""
    return ((common.mix(rids.astype(np.uint64)) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _marks(rids: np.ndarray, places: np.ndarray, n: int) -> list[tuple[int, bytes]]:
    """(-1 - home, marks) of marked places: one row for each home, not for each row of the table."""
    home = _home(rids, n)
    order = np.lexsort((places, rids, home))
    edges = np.flatnonzero(np.diff(home[order])) + 1
    return [(-1 - int(home[part[0]]), _pack(_MARK, [rids[part], places[part]])) for part in np.split(order, edges) if len(part)]


def _blocks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())], ["range", "data"])


def _sent(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 1024):
        yield _blocks(rows[i : i + 1024])


_ANCHOR = np.dtype([("h", "<u4"), ("rid", "<i8"), ("at", "<u4")])
_WINDOW = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("rid", "<i8"), ("at", "<u4")])


def _pack(kind: np.dtype, columns: list[np.ndarray]) -> bytes:
    """Column after column, which compresses well."""
    return b"".join(c.astype(kind[i]).tobytes() for i, c in enumerate(columns))


def _unpack(kind: np.dtype, blocks: list[bytes]) -> list[np.ndarray]:
    width, out = kind.itemsize, [[] for _ in kind.names]
    for block in blocks:
        n, at = len(block) // width, 0
        for i in range(len(kind.names)):
            out[i].append(np.frombuffer(block, kind[i], n, at))
            at += n * kind[i].itemsize
    return [np.concatenate(c) for c in out]


def _anchors(n: int, period: int, count: int):
    cover = np.zeros(period, dtype=bool)
    cover[list(difference_cover(period))] = True
    size = n - period + 1

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        hashes, rids, places = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        first = np.concatenate(([True], ~same))
        again = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        shared = order[again]
        yield from _sent(_marks(rids[shared], places[shared], count))
        send = np.sort(order[first])
        yield from _sent([(k, _pack(_ANCHOR, [hashes[send[i]] & np.uint64(0xFFFFFFFF), rids[send[i]], places[send[i]]])) for k, i in _by_range(hashes[send], count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            texts, rids = common.column_bytes(batch.column(0)), batch.column(1).to_numpy()
            for a, b in common.slices(texts, 1 << 20):
                joined, starts, ends, first = common.words(texts[a:b])
                hashes = common.ngram_hashes(common.word_hashes(joined, starts, ends), size)
                if not len(hashes):
                    continue
                doc = np.repeat(np.arange(b - a), np.diff(first))[: len(hashes)]
                place = np.arange(len(hashes)) - first[doc]
                ok = cover[place % period] & (place + size <= np.diff(first)[doc]) & (np.diff(first)[doc] >= n)
                held.append((hashes[ok], rids[a:b][doc[ok]], place[ok]))
                total += int(ok.sum())
                if total >= STRETCH:
                    yield from flush(held)
                    held, total = [], 0
        if total:
            yield from flush(held)

    return run


class _SharedAnchors:
    """Marks the places of a hash range's anchors that stand more than once."""

    def __init__(self, count: int) -> None:
        self.count = count
        self.kept = [*(np.empty(0, _ANCHOR[i]) for i in range(3)), np.empty(0, bool)]

    def add(self, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not blocks:
            return
        new = _unpack(_ANCHOR, blocks)
        hashes, rids, places, marked = (np.concatenate(x) for x in zip(self.kept, [*new, np.zeros(len(new[0]), bool)], strict=True))
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        found = order[shared & ~marked[order]]
        marked[order[shared]] = True
        first = order[np.concatenate(([True], ~same))]
        self.kept = [hashes[first], rids[first], places[first], marked[first]]
        yield from _sent(_marks(rids[found], places[found], self.count))

    def done(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def window_hashes(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every run of n words, of 64 and 32 bits. The second sums words mixed anew by another multiplier, so
    runs that agree in the first by their sum don't agree in it."""
    again = common.ngram_hashes(common.mix(words ^ np.uint64(0x2545F4914F6CDD1D)), n, 1, 0xD1342543DE82EF95)
    return common.ngram_hashes(words, n), (again >> np.uint64(32)).astype(np.uint32)


def _windows(n: int, period: int, count: int):
    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, rid, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, rid, doc, h2, h1))
        again = np.concatenate(([False], (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])))
        later = order[again]
        yield from _sent(_marks(rid[later], at[later], count))
        send = np.sort(order[~again])
        yield from _sent([(k, _pack(_WINDOW, [c[send[i]] for c in (h1, h2, doc, rid, at)])) for k, i in _by_range(h1[send], count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            texts, rids = common.column_bytes(batch.column(0)), batch.column(1).to_numpy()
            docs = np.array([_NO_ID if x is None else x for x in batch.column(2).to_pylist()], dtype=np.int64)
            marks = batch.column(3).to_pylist()
            for a, b in common.slices(texts, 1 << 20):
                joined, starts, ends, first = common.words(texts[a:b])
                words = common.word_hashes(joined, starts, ends)
                if len(words) < n:
                    continue
                size = np.diff(first)
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                for d in range(a, b):
                    base = first[d - a]
                    places = np.frombuffer(marks[d], "<u4").astype(np.int64)
                    np.add.at(edge, base + np.maximum(places - period + 1, 0), 1)
                    np.subtract.at(edge, base + places + 1, 1)
                doc = np.repeat(np.arange(b - a), size)
                place = np.arange(len(words)) - first[doc]
                at = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (place + n <= size[doc]))
                h1, h2 = window_hashes(words, n)
                held.append((h1[at], h2[at], docs[a:b][doc[at]], rids[a:b][doc[at]], place[at]))
                total += len(at)
                if total >= STRETCH:
                    yield from flush(held)
                    held, total = [], 0
        if total:
            yield from flush(held)

    return run


class _LaterWindows:
    """Marks the windows of a hash range that also start earlier."""

    def __init__(self, count: int) -> None:
        self.count = count
        self.kept = [np.empty(0, _WINDOW[i]) for i in range(5)]

    def add(self, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not blocks:
            return
        h1, h2, doc, rid, at = all_ = [np.concatenate(x) for x in zip(self.kept, _unpack(_WINDOW, blocks), strict=True)]
        order = np.lexsort((at, rid, doc, h2, h1))
        again = np.concatenate(([False], (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])))
        later = order[again]
        self.kept = [c[order[~again]] for c in all_]
        yield from _sent(_marks(rid[later], at[later], self.count))

    def done(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def _by_row(table: pa.Table) -> pa.Table:
    """(rid, its marked places in order) of a home's marks."""
    rids, places = _unpack(_MARK, table.column("data").to_pylist())
    order = np.lexsort((places, rids))
    rids, places = rids[order], places[order]
    if len(rids):
        new = np.concatenate(([True], (rids[1:] != rids[:-1]) | (places[1:] != places[:-1])))
        rids, places = rids[new], places[new]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(rids)) + 1, [len(rids)])).tolist()
    pairs = [(int(rids[a]), places[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False) if b > a]
    return pa.table([pa.array([k for k, _ in pairs], pa.int64()), pa.array([v for _, v in pairs], pa.binary())], ["rid", "places"])


def _met(blocks: DataFrame, merge, count: int, name: str) -> DataFrame:
    """Marks by row key: those that a task found by itself, and those that merging each hash range finds."""

    class Passed:
        """A home's marks go on as they are."""

        def __init__(self, place: int) -> None:
            self.place = place

        def add(self, data: list[bytes]) -> Iterator[pa.RecordBatch]:
            yield from _sent([(self.place, x) for x in data])

        def done(self) -> Iterator[pa.RecordBatch]:
            return iter(())

    merged = common.folded(blocks, "range", lambda k: merge(count) if k >= 0 else Passed(k), BLOCK_SCHEMA)
    return common.written(merged.groupBy("range").applyInArrow(_by_row, "rid long, places binary"), name)


def repeated_windows(docs: DataFrame, n: int = 20, period: int = 13) -> DataFrame:
    """For rows of docs (doc_id, text, rid) that hold any: rid and the places (32-bit integers) at which a window of n
    words starts whose words also start earlier."""
    count = ranges(docs)
    anchors = _met(docs.select("text", "rid").mapInArrow(_anchors(n, period, count), BLOCK_SCHEMA), _SharedAnchors, count, "anchor-marks")
    marked = docs.join(anchors, "rid").select("text", "rid", "doc_id", "places")
    return _met(marked.mapInArrow(_windows(n, period, count), BLOCK_SCHEMA), _LaterWindows, count, "window-marks")


def without_repeats(docs: DataFrame, n: int = 20, period: int = 13, joined: bool = False, key: str | None = None) -> DataFrame:
    """Each row's doc_id, rid, n_words, n_removed and kept: its text without the words of windows that start earlier.

    A removed run goes with the white space after it. With joined, kept is the kept words with one space between. rid is
    docs' column `key`, or a key of its own.
    """
    keyed = common.row_keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), key=key)
    marked = keyed.join(repeated_windows(keyed, n, period), "rid", "left").select("doc_id", "rid", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts, places = common.column_bytes(part.column(2)), part.column(3).to_pylist()
                totals, removed, kept = [], [], []
                for text, marks in zip(texts, places, strict=True):
                    if marks is None:
                        words = text.split()
                        totals.append(len(words))
                        removed.append(0)
                        kept.append(b" ".join(words) if joined else text)
                        continue
                    whole, starts, ends, _ = common.words([text])
                    edge = np.zeros(len(starts) + 1, dtype=np.int32)
                    at = np.frombuffer(marks, "<u4").astype(np.int64)
                    np.add.at(edge, at, 1)
                    np.subtract.at(edge, at + n, 1)
                    keep = np.cumsum(edge[:-1]) == 0
                    totals.append(len(starts))
                    removed.append(len(starts) - int(keep.sum()))
                    stops = ends if joined else np.concatenate((starts[1:], [len(text)]))
                    change = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=0, append=0))
                    pieces = [(int(starts[x]), int(stops[y - 1])) for x, y in zip(change[0::2], change[1::2], strict=True)]
                    if joined:
                        kept.append(b" ".join(b" ".join(whole[x:y].split()) for x, y in pieces))
                    else:
                        kept.append((text[: int(starts[0])] if len(starts) else text) + b"".join(text[x:y] for x, y in pieces))
                texts = pa.array(kept, pa.binary()).cast(pa.string())
                columns = [part.column(0), part.column(1), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), texts]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "rid", "n_words", "n_removed", "kept"])

    return marked.mapInArrow(run, "doc_id long, rid long, n_words long, n_removed long, kept string")
