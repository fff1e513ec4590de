"""Scoring texts with a smoothed trigram model in a trie of Elias-Fano levels.

Level one is the vocabulary, cut by hash into files: sorted 64-bit word hashes and the running count of their tokens
(Elias-Fano), from which a word's count is a difference. A word's id is its rank, so ids and files go together.
Levels two and three hold the successors of words and of pairs. The tokens of the corpus, in the order of (word, next
word), are cut into shares of equal token counts, so a word that a large part of all tokens follows spans several files
and no task holds it whole. A file has monotone pointers from words to their successors, and from each such pair to the
pair's successors; successors are relative to their context, as one rising sequence of each level. Each entry has an
8-bit code of its discounted probability, each context one of its back-off weight. A query finds a pair among its word's
successors between two pointers, and from its place the next word among the pair's.

Smoothing is interpolated absolute discounting from pairs over words to an add-half unigram base. All tokens of the
training texts are counted; exchanges carry one entry of a word or triple for each stretch of a task, and what a share
gathers is merged in pieces, so a triple in every stretch takes a line of memory. Files lie in the shared folder and are
memory-mapped by the tasks that score (on other stores: copied to an unlinked temporary file first). The driver holds
two numbers for each file.

Defined cases: a null text counts as empty and still has its end token; the end token stands before a text's first word,
twice; ids that repeat or are null are scored row by row (a null id hashes as an empty text); with no training token
every probability is the base's (half of one over the same); very long texts and words are taken whole, in runs of
bounded size. Only doc_id and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .elias_fano import EliasFano, encode
from .substrings import ranges

END = np.uint64(0x5DEECE66D1CE4E5B)
#: What is taken off the counts of pairs and of triples. Most triples occur once, and few of those come again.
DISCOUNT, TRIPLE_DISCOUNT = 0.85, 0.95
STRETCH = 1 << 18
#: Bytes of input for each share and hash range; bounds the arrays of a task that merges or builds one.
SHARE_BYTES = 8 << 20
CODES = 256


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens of all texts, each text's end with them; number of tokens of each text)."""
    joined, starts, ends, first = common.words([common.lower_ascii(x) for x in texts])
    hashes = common.word_hashes(joined, starts, ends)
    size = np.diff(first)
    out = np.full(len(hashes) + len(texts), END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(size + 1) - 1] = False
    out[keep] = hashes
    return out, size + 1


def _range_of(hashes: np.ndarray, count: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _sent(place: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of columns by place; place is rising."""
    edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
    rows = [(int(place[a]), b"".join(c[a:b].tobytes() for c in columns)) for a, b in zip(edges, edges[1:], strict=False) if b > a]
    for i in range(0, len(rows), 512):
        keys, data = zip(*rows[i : i + 512], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], ["place", "data"])


def _columns(blocks: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    width, out = sum(np.dtype(k).itemsize for k in kinds), [[] for _ in kinds]
    for data in blocks:
        n, at = len(data) // width, 0
        for i, k in enumerate(kinds):
            out[i].append(np.frombuffer(data, k, n, at))
            at += n * np.dtype(k).itemsize
    return [np.concatenate(x) for x in out]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[edge], np.add.reduceat(counts, edge) if len(keys) else counts


def _batches(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, int, int, list[bytes]]]:
    for batch in batches:
        texts = common.column_bytes(batch.column(column))
        for a, b in common.slices(texts, most):
            yield batch, a, b, texts[a:b]


def words_file(folder: str, k: int) -> str:
    return f"{folder}/words-{k:08d}"


def share_file(folder: str, k: int) -> str:
    return f"{folder}/share-{k:08d}"


def edge_file(folder: str, k: int) -> str:
    return f"{folder}/edge-{k:08d}"


@dataclass
class Vocabulary:
    """Level one: the folder of its files, ids before each hash range and in all, tokens before each and in all. A range
    without ids has no file. These are two numbers for each file, whatever the files hold."""

    folder: str
    ids: np.ndarray
    tokens: np.ndarray

    def __post_init__(self) -> None:
        self.size, self.total = int(self.ids[-1]), int(self.tokens[-1])
        self._open: dict[int, tuple[np.ndarray, EliasFano]] = {}

    def __getstate__(self):
        return self.folder, self.ids, self.tokens

    def __setstate__(self, state) -> None:
        self.folder, self.ids, self.tokens = state
        self.__post_init__()

    def _file(self, k: int) -> tuple[np.ndarray, EliasFano]:
        if k not in self._open:
            data = common.mapped_file(words_file(self.folder, k))
            running = EliasFano(data)
            self._open[k] = np.frombuffer(data, "<u8", running.n - 1, running.end), running
        return self._open[k]

    def _by_file(self, place: np.ndarray) -> Iterator[tuple[int, int, int]]:
        edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a and self.ids[int(place[a])] < self.ids[int(place[a]) + 1]:
                yield int(place[a]), a, b

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id or -1, tokens before it, its count) of hashes in rising order."""
        ids, before, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        for k, a, b in self._by_file(_range_of(hashes, len(self.ids) - 1)):
            own, running = self._file(k)
            at = np.searchsorted(own, hashes[a:b])
            hit = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == hashes[a:b])
            at = at[hit]
            ids[a + hit] = at + self.ids[k]
            low = running.get(at).astype(np.int64)
            before[a + hit] = low + self.tokens[k]
            count[a + hit] = running.get(at + 1).astype(np.int64) - low
        return ids, before, count

    def counts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens before, count) of ids in rising order."""
        before, count = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        for k, a, b in self._by_file(np.searchsorted(self.ids, ids, side="right") - 1):
            _, running = self._file(k)
            at = ids[a:b] - self.ids[k]
            low = running.get(at).astype(np.int64)
            before[a:b], count[a:b] = low + self.tokens[k], running.get(at + 1).astype(np.int64) - low
        return before, count

    def base(self, count: np.ndarray) -> np.ndarray:
        """The add-half unigram probability of a token of that count."""
        return (count + 0.5) / (self.total + 0.5 * (self.size + 1))


def count_tokens(docs: DataFrame, folder: str) -> Vocabulary:
    """Counts all tokens of the texts (one column `text`) into level-one files."""
    n = ranges(docs, SHARE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield from _sent(_range_of(keys, n), [keys, counts.astype("<u8")])

        held, total = [], 0
        for _, _, _, texts in _batches(batches, 0):
            held.append(tokens(texts)[0])
            total += len(held[-1])
            if total >= STRETCH:
                yield from give(held)
                held, total = [], 0
        if total:
            yield from give(held)

    class Words:
        """Sums a hash range's counts and writes its file."""

        def __init__(self, place: int) -> None:
            self.place, self.keys, self.counts = place, np.empty(0, np.uint64), np.empty(0, np.uint64)

        def add(self, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
            if blocks:
                keys, counts = _columns(blocks, ["<u8", "<u8"])
                self.keys, self.counts = _summed(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
            return iter(())

        def done(self) -> Iterator[pa.RecordBatch]:
            running = np.concatenate(([0], np.cumsum(self.counts))).astype(np.uint64)
            common.write_file(words_file(folder, self.place), iter((encode(running), self.keys.astype("<u8").tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (self.place, len(self.keys), int(running[-1]))], ["place", "n", "tokens"])

    blocks = docs.select("text").mapInArrow(run, "place long, data binary")
    made = common.folded(blocks, "place", Words, "place long, n long, tokens long")
    ids, before = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    for r in common.written(made, "word-files").toLocalIterator():
        ids[r.place + 1], before[r.place + 1] = r.n, r.tokens
    return Vocabulary(folder, np.cumsum(ids), np.cumsum(before))


def _share(before: np.ndarray, count: np.ndarray, word: np.ndarray, size: int, step: int) -> np.ndarray:
    """The share of the corpus in which a pair lies: rises with (context, word), by the context's tokens and, within
    them, by the word's id."""
    inside = np.minimum((count * (word / max(1, size))).astype(np.int64), np.maximum(count - 1, 0))
    return (before + inside) // step


@dataclass
class _Tokens:
    """The tokens of some texts: distinct ones with their ids, tokens before and counts, which of them each token is, and
    the texts' sizes and first tokens."""

    ids: np.ndarray
    before: np.ndarray
    count: np.ndarray
    kind: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary, texts: list[bytes]) -> _Tokens:
        hashes, sizes = tokens(texts)
        keys, kind = np.unique(hashes, return_inverse=True)
        return cls(*vocabulary.look(keys), kind, sizes, np.cumsum(sizes) - sizes)

    def previous(self) -> np.ndarray:
        """The kind before each token; the end token before a text's first."""
        out = np.empty_like(self.kind)
        out[1:] = self.kind[:-1]
        out[self.starts] = self.kind[self.starts + self.sizes - 1]
        return out


@dataclass
class Model:
    """All levels: the vocabulary, which shares have a file, tokens of a share, the end token's id."""

    vocabulary: Vocabulary
    shares: np.ndarray
    step: int

    def __post_init__(self) -> None:
        self._open: dict[int, Share] = {}
        self._edges: dict[int, float] = {}

    def __getstate__(self):
        return self.vocabulary, self.shares, self.step

    def __setstate__(self, state) -> None:
        self.vocabulary, self.shares, self.step = state
        self.__post_init__()

    def share(self, k: int) -> Share | None:
        if k not in self._open:
            self._open[k] = Share(common.mapped_file(share_file(self.vocabulary.folder, k))) if self.shares[k] else None
        return self._open[k]

    def edge(self, k: int) -> float:
        """The back-off weight of the word whose successors start in share k and go on after it."""
        if k not in self._edges:
            self._edges[k] = float(np.frombuffer(common.read_file(edge_file(self.vocabulary.folder, k)), "<f8")[0])
        return self._edges[k]

    def weights(self, ids: np.ndarray, before: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Back-off weights of words as contexts; 1 for words that aren't known."""
        out = np.ones(len(ids))
        known = np.flatnonzero((ids >= 0) & (count > 0))
        home = before[known] // self.step
        wide = (before[known] + count[known] - 1) // self.step != home
        for k, i in zip(home[wide].tolist(), known[wide].tolist(), strict=True):
            out[i] = self.edge(k)
        known, home = known[~wide], home[~wide]
        for k, part in _groups(home):
            out[known[part]] = self.share(k).weight(ids[known[part]])
        return out

    def log_probabilities(self, t: _Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of each token's base probability, of its probability after the two tokens before it)."""
        n, base = len(t.kind), self.vocabulary.base(t.count)
        before = t.previous()
        pair = np.zeros(n)
        weight = self.weights(t.ids, t.before, t.count)[before]
        triple, pair_weight = np.zeros(n), np.ones(n)
        # The pair that ends with a token is also the context of the next one; a text's first token follows two ends.
        last = t.starts + t.sizes - 1
        follows = np.append(np.arange(1, n), 0)
        follows[last] = -1
        context = np.concatenate((before, t.kind[last]))
        word, follows = np.concatenate((t.kind, t.kind[last])), np.concatenate((follows, t.starts))
        ok = np.flatnonzero((t.count[context] > 0) & (t.ids[word] >= 0))
        # Pairs that repeat are looked up once, in order, so those of a share lie together.
        names = len(t.ids)
        pairs, which = np.unique(t.ids[context[ok]].astype(np.uint64) * np.uint64(self.vocabulary.size) + t.ids[word[ok]].astype(np.uint64), return_inverse=True)
        one = np.empty(len(pairs), dtype=np.int64)
        one[which] = ok
        c, w = t.ids[context[one]], t.ids[word[one]]
        place = _share(t.before[context[one]], t.count[context[one]], w, self.vocabulary.size, self.step)
        to = follows[ok]
        more = np.flatnonzero(to >= 0)
        after = t.kind[to[more]]
        more, after = more[t.ids[after] >= 0], after[t.ids[after] >= 0]
        # Words in the order of their ids, so that pairs with a word after them are in the order of the file too.
        order = np.argsort(t.ids, kind="stable")
        rank = np.empty(names, dtype=np.int64)
        rank[order] = np.arange(names)
        triples, which3 = np.unique(which[more] * names + rank[after], return_inverse=True)
        of_pair, last_word = triples // max(names, 1), t.ids[order[triples % max(names, 1)]] if names else triples
        first, back, seen, second = np.zeros(len(pairs)), np.ones(len(pairs)), np.zeros(len(pairs), dtype=bool), np.zeros(len(triples))
        edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
        for x, y in zip(edges, edges[1:], strict=False):
            if y > x and (share := self.share(int(place[x]))) is not None:
                p, q = np.searchsorted(of_pair, (x, y))
                first[x:y], back[x:y], seen[x:y], second[p:q] = share.look(c[x:y], w[x:y], of_pair[p:q] - x, last_word[p:q])
        real = ok < n
        pair[ok[real]] = first[which[real]]
        next_ = np.flatnonzero((to >= 0) & seen[which])
        pair_weight[to[next_]] = back[which[next_]]
        triple[to[more]] = second[which3]
        own = base[t.kind]
        return np.log10(own), np.log10(triple + pair_weight * (pair + weight * own))


def _groups(place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(place, kind="stable")
    edges = [0, *(np.flatnonzero(np.diff(place[order])) + 1).tolist(), len(order)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(place[order[a]]), order[a:b]


class Share:
    """A file of levels two and three: header, code books, pointers and successors of each level, codes of successors and
    of contexts."""

    def __init__(self, data) -> None:
        self.low, self.contexts, self.size = np.frombuffer(data, "<i8", 3).tolist()
        books = np.frombuffer(data, "<f8", 4 * CODES, 24).reshape(4, CODES)
        self.book, self.weights, self.triple_book, self.pair_weights = books
        self.pointers = EliasFano(data, 24 + 32 * CODES)
        self.successors = EliasFano(data, self.pointers.end)
        self.pair_pointers = EliasFano(data, self.successors.end)
        self.thirds = EliasFano(data, self.pair_pointers.end)
        at = self.thirds.end
        sizes = (self.successors.n, self.contexts, self.thirds.n, self.successors.n)
        self.codes, self.context_codes, self.third_codes, self.pair_codes = (np.frombuffer(data, np.uint8, n, at + sum(sizes[:i])) for i, n in enumerate(sizes))

    def weight(self, context: np.ndarray) -> np.ndarray:
        """Back-off weights of words all of whose successors are in this file."""
        return self.weights[self.context_codes[context - self.low]]

    def look(self, context: np.ndarray, word: np.ndarray, of_pair: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of pairs (in order, each once): discounted probability, back-off weight, whether the pair is here; and of the
        words `after` pairs (by place in these, rising): the triple's discounted probability."""
        n = len(context)
        first, back, seen, second = np.zeros(n), np.ones(n), np.zeros(n, dtype=bool), np.zeros(len(after))
        at = context - self.low
        ok = np.flatnonzero((at >= 0) & (at < self.contexts))
        at, spread = np.unique(at[ok], return_inverse=True)
        start, stop = self.pointers.get(at).astype(np.int64)[spread], self.pointers.get(at + 1).astype(np.int64)[spread]
        # A context's successors follow those of the one before: its rank times the vocabulary, and the word.
        place = self.successors.find(at[spread].astype(np.uint64) * np.uint64(self.size) + word[ok].astype(np.uint64), start, stop)
        ok, place = ok[place >= 0], place[place >= 0]
        first[ok], back[ok], seen[ok] = self.book[self.codes[place]], self.pair_weights[self.pair_codes[place]], True
        if len(after):
            start, stop, rank = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            start[ok], stop[ok], rank[ok] = self.pair_pointers.get(place), self.pair_pointers.get(place + 1), place
            wanted = np.flatnonzero(stop[of_pair] > start[of_pair])
            own = of_pair[wanted]
            third = self.thirds.find(rank[own].astype(np.uint64) * np.uint64(self.size) + after[wanted].astype(np.uint64), start[own], stop[own])
            second[wanted[third >= 0]] = self.triple_book[self.third_codes[third[third >= 0]]]
        return first, back, seen, second


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code book of CODES entries, code of each value): code 0 is zero, the others geometric means of bins of the positive
    values. Half of the bins' edges part equal numbers of values, half lie at equal ratios, which bounds every error."""
    book, codes = np.zeros(CODES), np.zeros(len(values), np.uint8)
    some = np.flatnonzero(values > 0)
    if len(some):
        logs = np.log(values[some])
        inner = np.linspace(0, 1, CODES // 2)[1:-1]
        edges = np.unique(np.concatenate((np.quantile(logs, inner), logs.min() + inner * (logs.max() - logs.min()))))
        codes[some] = np.searchsorted(edges, logs, side="left") + 1
        sums, sizes = np.bincount(codes[some], weights=logs, minlength=CODES), np.bincount(codes[some], minlength=CODES)
        book[sizes > 0] = np.exp(sums[sizes > 0] / sizes[sizes > 0])
    return book, codes


def _triples(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """(context, word, next word, times) in order, each once."""
    context, word, after, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    wide = int(max(context.max(initial=0), word.max(initial=0))) >> 32
    order = np.lexsort((after, word, context) if wide else (after, context << 32 | word))
    context, word, after, times = context[order], word[order], after[order], times[order]
    if not len(order):
        return [context, word, after, times]
    new = (context[1:] != context[:-1]) | (word[1:] != word[:-1]) | (after[1:] != after[:-1])
    edge = np.flatnonzero(np.concatenate(([True], new)))
    return [context[edge], word[edge], after[edge], np.add.reduceat(times, edge)]


def share_bytes(v: Vocabulary, end: int, context: np.ndarray, word: np.ndarray, after: np.ndarray, times: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(a share's file, its words as contexts with their tokens before and numbers of successors) of triples in order. An
    after of v.size stands for none: it counts pairs that end a text."""
    low, high = int(context[0]), int(context[-1]) + 1
    new = np.concatenate(([True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])))
    edge, rank = np.flatnonzero(new), np.cumsum(new) - 1
    third = np.flatnonzero(after < v.size)
    followed = np.bincount(rank[third], weights=times[third], minlength=len(edge))
    ends = np.bincount(rank, weights=times * (after == v.size), minlength=len(edge))
    kinds = np.bincount(rank[third], minlength=len(edge))
    pair_context, pair_word = context[edge], word[edge]
    count = np.where(pair_word == end, ends, followed)  # two ends are a pair only where a text is empty
    at = pair_context - low
    total_before, total = v.counts(np.arange(low, high))
    sizes = np.bincount(at, minlength=high - low)
    real = np.bincount(at, weights=count > 0, minlength=high - low)
    book, codes = quantised(np.maximum(count - DISCOUNT, 0) / np.maximum(total[at], 1))
    weights, context_codes = quantised(DISCOUNT * real / np.maximum(total, 1))
    triple_book, third_codes = quantised((times[third] - TRIPLE_DISCOUNT) / followed[rank[third]])
    pair_weights, pair_codes = quantised(np.where(followed > 0, TRIPLE_DISCOUNT * kinds / np.maximum(followed, 1), 1.0))
    size = np.uint64(v.size)
    parts = [
        np.array([low, high - low, v.size], dtype="<i8").tobytes(),
        *(b.astype("<f8").tobytes() for b in (book, weights, triple_book, pair_weights)),
        encode(np.concatenate(([0], np.cumsum(sizes)))),
        encode(at.astype(np.uint64) * size + pair_word.astype(np.uint64)),
        encode(np.concatenate(([0], np.cumsum(kinds)))),
        encode(rank[third].astype(np.uint64) * size + after[third].astype(np.uint64)),
        *(x.tobytes() for x in (codes, context_codes, third_codes, pair_codes)),
    ]
    return parts, np.arange(low, high), total_before, real


def train(docs: DataFrame) -> Model:
    """Counts the texts of docs (one column `text`) and builds all levels in the shared folder."""
    common.bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    folder = common.new_folder(spark, "language-model")
    vocabulary = count_tokens(docs, folder)
    n = ranges(docs, SHARE_BYTES)
    step = max(1, -(-vocabulary.total // n))
    # Columns of an entry: ids by their low and high halves, as sorted columns of few values pack well.
    half = "<u4" if vocabulary.size >= (1 << 32) - 1 else "<u2"
    bits, most = (32 if half == "<u4" else 16), 0xFFFF
    kinds = [half] * 6 + ["<u2"]
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value

        def give(parts: list) -> Iterator[pa.RecordBatch]:
            context, word, after, times = _triples([p[1:] for p in parts])
            named = np.unique(np.concatenate([p[0] for p in parts], axis=1), axis=1)  # each context once: id, before, count
            i = np.searchsorted(named[0], context)
            place = _share(named[1][i], named[2][i], word, v.size, step)
            over = times // (most + 1)  # a number that two bytes don't hold goes as several entries
            if over.any():
                again = np.repeat(np.arange(len(times)), over + 1)
                first = np.concatenate(([True], again[1:] != again[:-1]))
                context, word, after, place = context[again], word[again], after[again], place[again]
                times = np.where(first, times[again] - most * over[again], most)
            halves = [x for c in (context, word, after) for x in ((c >> bits).astype(half), (c & ((1 << bits) - 1)).astype(half))]
            yield from _sent(place, [*halves, times.astype("<u2")])

        held, total = [], 0
        for _, _, _, texts in _batches(batches, 0):
            t = _Tokens.of(v, texts)
            word = t.previous()
            last = t.starts + t.sizes - 1
            context = np.empty_like(word)
            context[1:] = word[:-1]
            context[t.starts] = t.kind[last]
            # The last pair of a text has no word after it.
            context, after = np.concatenate((context, word[last])), np.concatenate((t.ids[t.kind], np.full(len(last), v.size)))
            word = np.concatenate((word, t.kind[last]))
            held.append((np.stack((t.ids, t.before, t.count)), t.ids[context], t.ids[word], after, np.ones(len(after), np.int64)))
            total += len(after)
            if total >= STRETCH:
                yield from give(held)
                held, total = [], 0
        if total:
            yield from give(held)

    schema = "place long, context long, home long, total long, kinds long"

    class Shared:
        """Merges a share's triples and writes its file. Gives out the share, and words whose successors lie in several."""

        def __init__(self, place: int) -> None:
            self.place, self.kept = place, [np.empty(0, np.int64)] * 4

        def add(self, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
            if blocks:
                *ids, times = (x.astype(np.int64) for x in _columns(blocks, kinds))
                self.kept = _triples([self.kept, [*(ids[i] << bits | ids[i + 1] for i in (0, 2, 4)), times]])
            return iter(())

        def done(self) -> Iterator[pa.RecordBatch]:
            v = shared.value
            end = int(v.look(np.array([END]))[0][0])
            parts, words, before, real = share_bytes(v, end, *self.kept)
            common.write_file(share_file(folder, self.place), iter(parts))
            total = v.counts(words)[1]
            wide = np.flatnonzero((before // step != (before + total - 1) // step) & (real > 0))
            rows = [(self.place, -1, -1, -1, -1), *((self.place, int(words[i]), int(before[i] // step), int(total[i]), int(real[i])) for i in wide)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [x.split()[0] for x in schema.split(", ")])

    entries = docs.select("text").mapInArrow(run, "place long, data binary")
    built = common.written(common.folded(entries, "place", Shared, schema, 32 << 20), "share-files")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                weight = np.array([DISCOUNT * r["kinds"] / r["total"]], "<f8").tobytes()
                common.write_file(edge_file(folder, r["home"]), iter((weight,)))
            yield batch.select(["home"])

    # A share holds the start of at most one word that goes on after it: one small file for each such share.
    wide = built.filter("context >= 0").groupBy("context", "home", "total").agg(F.sum("kinds").alias("kinds"))
    common.written(wide.mapInArrow(edges, "home long"), "edge-files")
    shares = np.zeros(n + 1, dtype=bool)
    for r in built.filter("context < 0").select("place").toLocalIterator():
        shares[r.place] = True
    return Model(vocabulary, shares, step)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Of each row of docs (doc_id, text): doc_id, n_tokens, n_known, base_score and score (log10 probabilities)."""
    common.bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, a, b, texts in _batches(batches, 1, 1 << 22):
            t = _Tokens.of(m.vocabulary, texts)
            base, own = (np.add.reduceat(x, t.starts) for x in m.log_probabilities(t))
            known = np.add.reduceat((t.count[t.kind] > 0).astype(np.int64), t.starts)
            columns = [batch.column(0).slice(a, b - a), pa.array(t.sizes.astype(np.int64)), pa.array(known), pa.array(base), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Trains on the documents that aren't held out and scores all."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score")
