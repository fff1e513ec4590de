"""Benchmark decontamination by latent semantic retrieval of passages.

1. Texts become word ids of the benchmark's vocabulary (lower-cased, punctuation dropped; other words are one id without
   direction) in one pass for all items, written once.
2. Document frequencies over all passages, then a randomised SVD of the TF-IDF passages of the corpus: each task adds up
   its part of A'AW for a test matrix W that mixes the benchmark's own directions with Gaussian ones, parts are summed in
   a tree, and the driver factors the small result (Nystrom's form, one pass over the corpus). The items join it as
   ordinary rows, as many times as give them the corpus's weight; of the factorisation of both only the leading
   directions are kept, by default half as many as the group has items.
3. Items and passages (two blocks of BLOCK words) are folded alike: the sum of their words' rows of U / S. The cosine of
   the two folded vectors, each by its own length in the latent space, chooses the candidates.
4. Of candidates, those whose neighbourhood can't hold enough of the item's words are passed over (a count of words in
   common bounds any common subsequence, so nothing is lost). The others are checked by the longest common subsequence of
   item and neighbourhood, bit-parallel. An exact or lightly edited passage is a leak by the share of the item that is
   in order; a paraphrase (a lesser share) only if the item's answer is there too: the `answer` column's words, or else
   those of its last quarter.

The benchmark is a stated query set: its items go through steps 2 to 4 in groups of at most GROUP_ITEMS items and
GROUP_WORDS words, each with a latent space of its own, and through step 1 in rounds of at most ROUND_WORDS words, which
bounds what is broadcast and what the driver factors, at any size of either table.

Defined cases: null or empty texts and items match nothing; items of fewer than `shortest` words are only found whole
and in a row; rows with repeated or null ids are told apart by row key and each reported; an item that repeats under
several ids is reported for each; very long texts are searched whole, in parts that overlap. Only doc_id and text of
documents and item_id, text and, if there, answer of items are read, so columns of other names clash with nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _common as common

BLOCK = 16
GROUP_ITEMS, GROUP_WORDS, ROUND_WORDS = 256, 16_000, 4_000_000
#: Directions that the latent space keeps for each item of a group, and columns of the test matrix that sketches the
#: corpus. With as many directions as items the cosine would become the lexical one.
RANK, SKETCH = 0.5, 64
#: Least cosine of a candidate, least shares of an item's words in order for a leak and for a paraphrase.
COSINE, WHOLE, PARAPHRASE, ANSWER = 0.45, 0.75, 0.55, 0.6
SHORTEST = 8
_CHUNK = 4096  # numbers of a matrix that travel together

_CLEAN = bytes(0x20 if b < 0x30 or 0x3A <= b < 0x41 or 0x5B <= b < 0x61 or 0x7B <= b < 0x80 else b for b in range(256))


def clean_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_CLEAN).split()


@dataclass
class Items:
    """A group of items: their ids, words and answers' words as ids of the round's vocabulary."""

    keys: list
    words: list[list[int]]
    answers: list[list[int]]


@dataclass
class Round:
    """Groups of items that share a vocabulary and one encoding of the texts."""

    groups: list[Items]
    vocabulary: dict[bytes, int]


def item_rounds(items: DataFrame) -> Iterator[Round]:
    """The items in bounded rounds of bounded groups, in the order of item_id."""
    has_answer = "answer" in items.columns
    rows = items.select("item_id", "text", F.col("answer") if has_answer else F.lit(None).cast("string").alias("answer"))
    now, size, total = Round([], {}), 0, 0
    for row in rows.orderBy("item_id", "text", "answer").toLocalIterator():
        words = clean_words(row.text)
        if not words:
            continue
        if total and total + len(words) > ROUND_WORDS:
            yield now
            now, size, total = Round([], {}), 0, 0
        if not now.groups or len(now.groups[-1].keys) >= GROUP_ITEMS or size + len(words) > GROUP_WORDS:
            now.groups.append(Items([], [], []))
            size = 0
        group, number = now.groups[-1], now.vocabulary
        group.keys.append(row.item_id)
        group.words.append([number.setdefault(w, len(number)) for w in words])
        answer = clean_words(row.answer) or words[-max(1, len(words) // 4) :]
        group.answers.append([number.setdefault(w, len(number)) for w in answer])
        size, total = size + len(words) + len(answer), total + len(words) + len(answer)
    if now.groups:
        yield now


def encoded(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, rid and the words of docs as 32-bit ids of the vocabulary, its size for other words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, other, kind = shared.value.get, len(shared.value), "<u2" if len(shared.value) < 65535 else "<u4"
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                ids = []
                for text in part.column(1).to_pylist():
                    words = clean_words(text)
                    ids.append(np.fromiter(map(get, words, repeat(other)), dtype=kind, count=len(words)).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(ids, pa.binary())], ["doc_id", "rid", "ids"])

    return docs.select("doc_id", "text", "rid").mapInArrow(run, "doc_id long, rid long, ids binary")


def _pieces(batch: pa.RecordBatch, column: int, kind: str, other: int, most: int = 96_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word ids by block, filled up with `other`; row of each block; block's number in its row) of runs of rows. A very
    long row comes in parts, which overlap by one block."""
    ids, row, number, size = [], [], [], 0
    step = most // BLOCK * BLOCK
    for r, data in enumerate(batch.column(column).to_pylist()):
        words = np.frombuffer(data, kind)
        for a in range(0, len(words), step - BLOCK):
            part = words[a : a + step]
            if a and len(part) <= BLOCK:
                break
            if size and size + len(part) > most:
                yield np.concatenate(ids).reshape(-1, BLOCK), np.concatenate(row), np.concatenate(number)
                ids, row, number, size = [], [], [], 0
            count = -(-len(part) // BLOCK)
            ids += [part.astype(np.int32), np.full(count * BLOCK - len(part), other, np.int32)]
            row.append(np.full(count, r))
            number.append(a // BLOCK + np.arange(count))
            size += count * BLOCK
    if size:
        yield np.concatenate(ids).reshape(-1, BLOCK), np.concatenate(row), np.concatenate(number)


def _row_sums(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of the table's rows that each row of `at` names; column by column, as that stays in cache."""
    out = np.take(table, at[:, 0], axis=0)
    for k in range(1, at.shape[1]):
        out += np.take(table, at[:, k], axis=0)
    return out


def _group_sums(table: np.ndarray, at: np.ndarray, group: np.ndarray, wide: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(groups, sum of the rows of table that `at` names in each) for groups in rising order: groups are cut into runs of
    `wide`, summed, and their sums again."""
    names, size = np.unique(group, return_counts=True)
    table = np.vstack((table, np.zeros((1, table.shape[1]), table.dtype)))
    while len(at):
        runs = -(-size // wide)
        slot = np.arange(len(at)) + np.repeat((np.cumsum(runs) - runs) * wide - (np.cumsum(size) - size), size)
        grid = np.full(int(runs.sum()) * wide, len(table) - 1)
        grid[slot] = at
        sums = _row_sums(table, grid.reshape(-1, wide))
        if runs.max() == 1:
            return names, sums
        table, at, size = np.vstack((sums, np.zeros((1, sums.shape[1]), sums.dtype))), np.arange(len(sums)), runs
    return names, table[:0]


def _summed(df: DataFrame, fan_in: int = 64) -> np.ndarray:
    """The sum of matrices that tasks give out as rows (part, chunk, data): each chunk is summed in a tree; the driver
    gets one of each."""

    def add(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        total = np.frombuffer(data[0], "<f4").astype(np.float64)
        for x in data[1:]:
            total += np.frombuffer(x, "<f4")
        part, chunk = table.column("part")[0].as_py(), table.column("chunk")[0].as_py()
        return pa.table({"part": pa.array([part], pa.int64()), "chunk": pa.array([chunk], pa.int32()), "data": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    left = max(1, df.rdd.getNumPartitions())
    while left > 1:
        left = -(-left // fan_in)
        df = df.withColumn("part", F.pmod("part", F.lit(left))).groupBy("part", "chunk").applyInArrow(add, "part long, chunk int, data binary")
    return np.concatenate([np.frombuffer(r.data, "<f4").astype(np.float64) for r in sorted(df.collect(), key=lambda r: r.chunk)] or [np.empty(0)])


def _given(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, flat = TaskContext.get().partitionId(), np.ascontiguousarray(total, dtype="<f4").reshape(-1)
    for i, a in enumerate(range(0, len(flat), _CHUNK)):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([i], pa.int32()), pa.array([flat[a : a + _CHUNK].tobytes()], pa.binary())], ["part", "chunk", "data"])


def frequencies(words: DataFrame, size: int, kind: str) -> tuple[np.ndarray, int]:
    """(blocks that hold each word, blocks in all) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = np.zeros(size + 1), 0
        for batch in batches:
            for ids, row, _ in _pieces(batch, 2, kind, size):
                ids.sort(axis=1)
                new = np.concatenate((np.ones((len(ids), 1), bool), ids[:, 1:] != ids[:, :-1]), axis=1)
                total += np.bincount(ids[new], minlength=size + 1)
                blocks += len(row)
        # The number of blocks goes as two numbers that four bytes hold exactly.
        yield from _given(np.append(total, (blocks >> 20, blocks & 0xFFFFF)))

    total = _summed(words.mapInArrow(run, "part long, chunk int, data binary"))
    return (total[:-2], int(total[-2] * (1 << 20) + total[-1])) if len(total) else (np.zeros(size + 1), 0)


def sketch(words: DataFrame, local: np.ndarray, weight: np.ndarray, test: np.ndarray, kind: str) -> np.ndarray:
    """A'A times the test matrix, for A the TF-IDF rows of all passages (pairs of neighbouring blocks). local has the
    group's number of each word of the vocabulary, len(weight) for others."""
    n = len(weight)
    shared = words.sparkSession.sparkContext.broadcast((local, weight.astype(np.float32), test.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, w, omega = shared.value
        weighted, total = np.vstack((omega * w[:, None], np.zeros((1, omega.shape[1]), np.float32))), np.zeros(omega.shape)
        for batch in batches:
            for ids, row, _ in _pieces(batch, 2, kind, len(number) - 1):
                ids = number[ids]
                sums = _row_sums(weighted, ids)
                joined = np.flatnonzero(row[1:] == row[:-1])
                wide = 2 * sums  # each block's passages: with the one before and the one after
                wide[joined] += sums[joined + 1]
                wide[joined + 1] += sums[joined]
                flat = ids.reshape(-1).astype(np.uint16 if n < 65535 else np.int32)
                order = np.argsort(flat, kind="stable")
                order = order[: np.searchsorted(flat[order], n)]
                names, added = _group_sums(wide, order // BLOCK, flat[order])
                total[names] += added * w[names, None]
        yield from _given(total)

    flat = _summed(words.mapInArrow(run, "part long, chunk int, data binary"))
    return flat.reshape(n, -1) if len(flat) else np.zeros(test.shape)


@dataclass
class Space:
    """A group's latent space: the number of each word of the vocabulary in the group, the rows by which words fold (the
    last, of zeros, for words outside), the items' folded vectors of length 1."""

    local: np.ndarray
    fold: np.ndarray
    items: np.ndarray


def latent_space(group: Items, words: DataFrame, df: np.ndarray, blocks: int, kind: str, rank: int | None = None) -> Space:
    """The factors of the group's items and all passages, cut to `rank` directions (see RANK), and the items folded through them."""
    used = np.unique(np.concatenate([*map(np.asarray, group.words)]))
    n = len(used)
    local = np.full(len(df), n, dtype=np.int32)
    local[used] = np.arange(n)
    weight = np.log((1 + blocks) / (1 + df[used])) + 0.1
    own = np.zeros((len(group.keys), n))
    for i, ids in enumerate(group.words):
        np.add.at(own[i], local[ids], weight[local[ids]])
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    rng = np.random.default_rng(7)
    columns = min(n, SKETCH)
    test = own.T @ rng.standard_normal((len(own), columns)) + 0.1 * rng.standard_normal((n, columns))
    test, _ = np.linalg.qr(test)
    y = sketch(words, local, weight, test, kind)
    value, vector = np.linalg.eigh((test.T @ y + y.T @ test) / 2)
    good = value > max(value.max(), 1e-300) * 1e-7
    corpus = (y @ (vector[:, good] / np.sqrt(value[good]))).T  # rows whose products are those of the corpus's factors
    scale = np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-12) if len(corpus) else 1.0
    _, size, basis = np.linalg.svd(np.vstack((corpus, max(scale, 1e-6) * own)), full_matrices=False)
    kept = min(rank or max(1, round(RANK * len(own))), int((size > size.max() * 1e-5).sum()))
    factors = basis[:kept].T / size[:kept]
    items = own @ factors
    items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-30)
    fold = np.vstack((weight[:, None] * factors, np.zeros((1, kept))))
    return Space(local, (fold / max(np.abs(fold).max(), 1e-30)).astype(np.float32), items.astype(np.float32))


def lcs_ends(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of a with each prefix of b, by bit-parallel steps."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v, out = full, []
    for x in b:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        out.append(len(a) - v.bit_count())
    return out


def verify(item: list[int], answer: list[int], region: list[int], shortest: int = SHORTEST) -> tuple[float, float, int, int] | None:
    """(share of the item's words found in order, share of its answer, first word, end) if the region leaks the item."""
    ends = lcs_ends(item, region)
    best = ends[-1] if ends else 0
    share = best / len(item)
    if not best or share < (PARAPHRASE if len(item) >= shortest else 1):
        return None
    stop = ends.index(best) + 1
    back = lcs_ends(item[::-1], region[:stop][::-1])
    start = stop - (back.index(best) + 1)
    if stop - start > (2 * len(item) if len(item) >= shortest else len(item)):
        return None
    there = Counter(region[start : stop + len(answer)])
    found = sum(min(c, there[w]) for w, c in Counter(answer).items()) / max(1, len(answer))
    if share >= WHOLE or found >= ANSWER:
        return share, found, start, stop
    return None


LEAK_SCHEMA = "doc_id long, rid long, item long, cosine double, share double, answer double, start long, n_words long"


def _least(size: int) -> int:
    """Words of an item of that size that a leak has in order, at least."""
    return int(np.ceil(PARAPHRASE * size - 1e-9)) if size >= SHORTEST else size


def _possible(flat: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, times: np.ndarray, need: np.ndarray, other: int) -> np.ndarray:
    """Which candidates' neighbourhoods flat[low:high] hold at least `need` of their item's words, each counted at most as
    often as the item has it (times: of each item and word). No common subsequence is longer than that count."""
    out = np.zeros(len(low), dtype=bool)
    step = max(1, (1 << 19) // max(1, int((high - low).max(initial=1))))
    for a in range(0, len(low), step):
        part = slice(a, a + step)
        at = low[part, None] + np.arange(int((high[part] - low[part]).max()))
        ids = np.where(at < high[part, None], flat[np.minimum(at, len(flat) - 1)], other)
        ids.sort(axis=1)
        place = np.arange(ids.shape[1])
        first = np.where(np.concatenate((np.ones((len(ids), 1), bool), ids[:, 1:] != ids[:, :-1]), axis=1), place, 0)
        nth = place - np.maximum.accumulate(first, axis=1)
        out[part] = (nth < times[item[part, None], ids]).sum(axis=1) >= need[part]
    return out


def _search(group: Items, space: Space, kind: str, cosine: float, spark: SparkSession):
    shared = spark.sparkContext.broadcast((group.words, group.answers, space))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_words, answers, s = shared.value
        n = len(s.fold) - 1
        length = np.array([len(x) for x in item_words])
        least = np.array([_least(len(x)) for x in item_words])
        times = np.zeros((len(item_words), n + 1), dtype=np.uint32)
        for j, x in enumerate(item_words):
            np.add.at(times[j], s.local[x], 1)
        times[:, n] = 0
        for batch in batches:
            texts = [np.frombuffer(x, kind) for x in batch.column(2).to_pylist()]
            first = np.concatenate(([0], np.cumsum([len(x) for x in texts])))
            flat = s.local[np.concatenate(texts)] if first[-1] else np.empty(0, np.int32)
            best: dict[tuple[int, int], list[tuple[float, int]]] = {}
            for ids, row, number in _pieces(batch, 2, kind, len(s.local) - 1):
                sums = _row_sums(s.fold, s.local[ids])
                joined = np.flatnonzero(row[1:] == row[:-1])
                both = sums.copy()
                both[joined] += sums[joined + 1]
                size = np.linalg.norm(both, axis=1)
                at, j = np.nonzero(both @ s.items.T >= cosine * np.maximum(size, 1e-30)[:, None])
                if not len(at):
                    continue
                begin, end = first[row[at]], first[row[at] + 1]
                low = np.maximum(begin + number[at] * BLOCK - length[j], begin)
                high = np.minimum(begin + (number[at] + 2) * BLOCK + length[j], end)
                good = _possible(flat, low, high, j, times, least[j], n)
                at, j = at[good], j[good]
                score = np.einsum("ij,ij->i", both[at], s.items[j]) / size[at]
                for r, k, x, b in zip(row[at].tolist(), j.tolist(), score.tolist(), number[at].tolist(), strict=True):
                    best.setdefault((r, k), []).append((x, b))
            out = []
            for (r, j), places in sorted(best.items()):
                found = None
                for score, number in sorted(places, reverse=True):
                    low = max(0, number * BLOCK - len(item_words[j]))
                    region = texts[r][low : (number + 2) * BLOCK + len(item_words[j])].tolist()
                    got = verify(item_words[j], answers[j], region)
                    if got and (found is None or got[0] > found[1]):
                        found = (score, got[0], got[1], low + got[2], got[3] - got[2])
                        if got[0] == 1:
                            break
                if found:
                    out.append((batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), j, *found))
            if out:
                kinds = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in LEAK_SCHEMA.split(", ")])

    return run


def leaks(docs: DataFrame, items: DataFrame, cosine: float = COSINE, rank: int | None = None, key: str | None = None) -> DataFrame:
    """One row for each row of docs and item that it leaks: doc_id, rid, item_id, cosine, share, answer, start, n_words.
    rid is docs' column `key`, or a key of its own."""
    spark = docs.sparkSession
    keyed = common.row_keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), key=key)
    kind_of = items.schema["item_id"].dataType
    columns = ["doc_id", "rid", "item_id", "cosine", "share", "answer", "start", "n_words"]
    paths: list[str] = []
    for now in item_rounds(items):
        size = len(now.vocabulary)
        kind = "<u2" if size < 65535 else "<u4"
        words = common.written(encoded(keyed, now.vocabulary), "encoded")
        df, blocks = frequencies(words, size, kind)
        for group in now.groups:
            space = latent_space(group, words, df, blocks, kind, rank)
            found = words.mapInArrow(_search(group, space, kind, cosine, spark), LEAK_SCHEMA)
            names = spark.createDataFrame(list(enumerate(group.keys)), "item long, item_id long").withColumn("item_id", F.col("item_id").cast(kind_of))
            found = found.join(F.broadcast(names), "item").select(*columns)
            # Each group's finds are written, so that plans stay small however many groups there are.
            paths.append(common.new_folder(spark, "leaks"))
            found.write.parquet(paths[-1])
    if paths:
        return spark.read.schema(found.schema).parquet(*paths)
    nothing = [F.lit(None).cast(kind_of).alias("item_id"), *(F.lit(None).cast("double").alias(c) for c in columns[3:6]), *(F.lit(None).cast("long").alias(c) for c in columns[6:])]
    return keyed.filter("false").select("doc_id", "rid", *nothing)


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that leak no item; all columns stay."""
    rows, key = common.keyed(docs)
    found = leaks(rows, items, key=key).select(F.col("rid").alias(key))
    return rows.join(found, key, "left_anti").drop(key)
