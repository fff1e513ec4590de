"""Joining near copies: MinHash bands find candidates, full sets of word n-grams decide.

1. One pass over the texts makes each row's set of n-gram hashes and from it a 128-bit key of the set and its MinHash
   bands. Rows with equal sets (exact copies among them) become one text by grouping on the key.
2. Texts that share a band meet in its bucket. Buckets are counted by partial aggregation; of buckets with the same
   members one stays. No list of a bucket's members is gathered.
3. Members of buckets meet with their sets in tiles of at most 2 * TILE texts: a larger bucket is split into blocks and
   each pair of blocks is a tile, so no bucket is capped. A tile counts each text's links of similarity `threshold` or
   more (each pair only in the first bucket that it shares) and hands out a star of links for each group that it finds.
   Pairs of texts are never rows.
4. Connected components of those links are the classes.

Bands and rows are chosen for a target recall at the threshold; the default misses fewer than one in a thousand pairs
that are just at the threshold, and a class usually holds together by more than one pair.

Copies of a text and members of a class meet their text's and class's row by `_common.joined`, which joins hot keys where
their rows lie.

Defined cases: texts with fewer than n words have one n-gram, all their words; a text without words (null, empty) is
in no class but its own; rows of equal or null doc_id are told apart by row key; a class of null ids only has a null
class_id. Very long texts and words are taken whole, in runs of bounded size. Empty tables give no rows. Only doc_id
and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .components import components

WORDS, THRESHOLD = 5, 0.8
#: Texts of a block at most; a tile is one block or two.
TILE = 256


def choose_bands(threshold: float = THRESHOLD, recall: float = 0.999, most: int = 160) -> tuple[int, int]:
    """(bands, rows) with at least that recall at the threshold from at most `most` hashes: the most rows, as they let
    the fewest unlike pairs meet."""
    for rows in range(most, 0, -1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no bands reach that recall; allow more hashes")


def shingle_sets(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; one for all words of a shorter text; none for no words."""
    out: list[np.ndarray] = []
    for a, b in common.slices(texts):
        joined, starts, ends, first = common.words(texts[a:b])
        hashes = common.word_hashes(joined, starts, ends)
        grams = common.ngram_hashes(hashes, n)
        for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if y - x >= n:
                out.append(np.unique(grams[x : y - n + 1]))
            else:
                out.append(common.ngram_hashes(hashes[x:y], y - x, y - x) if y > x else np.empty(0, np.uint64))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


SIGNATURE_SCHEMA = "doc_id long, rid long, k1 long, k2 long, n_grams long, bands array<long>"


def signatures(docs: DataFrame, bands: int, rows: int, n: int = WORDS) -> DataFrame:
    """Of each row of docs (doc_id, text, rid): the key of its n-gram set, the set's size and its band hashes (null if it
    has no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(20240229)
        count = bands * rows
        times = (rng.integers(0, 1 << 32, count, dtype=np.uint64) << np.uint64(32) | rng.integers(0, 1 << 32, count, dtype=np.uint64)) | np.uint64(1)
        plus = rng.integers(0, 1 << 63, count, dtype=np.uint64)
        weights = rng.integers(0, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)
        names = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            texts = common.column_bytes(batch.column(1))
            k1, k2, sizes, made = [], [], [], []
            for grams in shingle_sets(texts, n):
                sizes.append(len(grams))
                if not len(grams):
                    k1.append(None)
                    k2.append(None)
                    made.append(None)
                    continue
                k1.append(_signed(int(common.mix(grams).sum(dtype=np.uint64))))
                k2.append(_signed(int(common.mix(grams ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64))))
                least = np.full(count, np.uint64((1 << 64) - 1))
                for i in range(0, len(grams), 512):
                    part = grams[i : i + 512] * times[:, None]
                    part += plus[:, None]
                    np.minimum(least, part.min(axis=1), out=least)
                made.append(common.mix((common.mix(least).reshape(bands, rows) * weights).sum(axis=1, dtype=np.uint64) + names).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sizes, pa.int64()), pa.array(made, pa.list_(pa.int64()))],
                ["doc_id", "rid", "k1", "k2", "n_grams", "bands"],
            )

    return docs.select("doc_id", "text", "rid").mapInArrow(run, SIGNATURE_SCHEMA)


def _tile(members: list[tuple], bucket: int, across: bool, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(text, links of it counted here, the smallest text of its group here) of a tile's members (rid, block's side,
    sorted buckets, grams). Pairs that share a smaller bucket are left to that one; with across, only pairs of
    different sides are looked at."""
    n = len(members)
    sets = [m[3] for m in members]
    size = np.array([len(s) for s in sets])
    open_pairs = np.minimum(size[:, None], size) >= threshold * np.maximum(size[:, None], size) - 1e-9
    np.fill_diagonal(open_pairs, False)
    if across:
        side = np.array([m[1] for m in members])
        open_pairs &= side[:, None] != side
    earlier = [m[2][: int(np.searchsorted(m[2], bucket))] for m in members]
    if sum(len(x) > 0 for x in earlier) > 1:
        owner = np.repeat(np.arange(n), [len(x) for x in earlier])
        names, place = np.unique(np.concatenate(earlier), return_inverse=True)
        grid = np.zeros((n, len(names)), dtype=np.float32)
        grid[owner, place] = 1
        open_pairs &= grid @ grid.T == 0
    live = np.flatnonzero(open_pairs.any(axis=1))
    if not len(live):
        return
    if len(live) == 2:
        common_grams = np.array([[0.0, len(np.intersect1d(sets[live[0]], sets[live[1]], assume_unique=True))]])
        common_grams = common_grams + np.zeros((2, 1))
        common_grams[1, 0] = common_grams[0, 1]
    else:
        owner = np.repeat(np.arange(len(live)), size[live])
        grams, place, times = np.unique(np.concatenate([sets[i] for i in live]), return_inverse=True, return_counts=True)
        keep = times[place] > 1
        column = np.cumsum(times > 1) - 1
        owner, place = owner[keep], column[place[keep]]
        common_grams = np.zeros((len(live), len(live)))
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        for low in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
            a, b = np.searchsorted(place, (low, low + 4096))
            grid = np.zeros((len(live), min(4096, int(place[-1]) + 1 - low)), dtype=np.float32)
            grid[owner[a:b], place[a:b] - low] = 1
            common_grams += grid @ grid.T
    total = size[live][:, None] + size[live] - common_grams
    linked = open_pairs[np.ix_(live, live)] & (common_grams >= threshold * total - 1e-9)
    count = linked.sum(axis=1)
    group = np.arange(len(live))
    rid = np.array([members[i][0] for i in live])
    order = np.argsort(rid)
    group = np.empty(len(live), dtype=np.int64)
    group[order] = np.arange(len(live))
    while True:  # the smallest rank that links reach
        low = np.where(linked, group[None, :], len(live)).min(axis=1)
        new = np.minimum(group, low)
        new = np.minimum(new, new[order[new]])
        if np.array_equal(new, group):
            break
        group = new
    for i in np.flatnonzero(count):
        yield int(rid[i]), int(count[i]), int(rid[order[group[i]]])


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    yield from zip(*(batch.column(k).slice(a, 256).to_pylist() for k in range(7)), strict=True)

        def give(found: list[tuple]) -> pa.RecordBatch:
            a, b, c = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["rid", "links", "least"])

        key, members, found = None, [], []
        for bucket, i, j, rid, side, buckets, grams in rows():
            if (bucket, i, j) != key:
                if len(members) > 1:
                    found += _tile(members, key[0], key[1] != key[2], threshold)
                key, members = (bucket, i, j), []
                if len(found) > 5000:
                    yield give(found)
                    found = []
            members.append((rid, side, np.array(buckets), np.frombuffer(grams, np.uint64)))
        if len(members) > 1:
            found += _tile(members, key[0], key[1] != key[2], threshold)
        if found:
            yield give(found)

    return run


def _with_grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                sets = shingle_sets(common.column_bytes(part.column(0)), n)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([x.tobytes() for x in sets], pa.binary())], ["rid", "met", "grams"])

    return run


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, recall: float = 0.999, key: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, rid (row key), class_id (the smallest doc_id of its class), links (how many
    other n-gram sets its own is linked with), copies (rows with its set) and chosen (the class's first row by doc_id,
    then row key; true for one row of each class). The row key is docs' column `key`, or one of its own."""
    bands, rows = choose_bands(threshold, recall)
    keyed = common.row_keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), key=key)
    signed = common.written(signatures(keyed, bands, rows, n), "signatures")
    texts = common.written(
        signed.filter("k1 is not null").groupBy("k1", "k2").agg(F.min("rid").alias("text"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")),
        "texts",
    )
    in_bucket = texts.select("text", F.explode("bands").alias("bucket"))
    met = in_bucket.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("text").cast("decimal(38,0)")).alias("s"), F.min("text").alias("lo"), F.max("text").alias("hi")).filter("n > 1")
    kept = met.groupBy("n", "s", "lo", "hi").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = in_bucket.join(kept, "bucket").groupBy(F.col("text").alias("rid")).agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("met"))
    sets = keyed.select("text", "rid").join(members, "rid").select("text", "rid", "met").mapInArrow(_with_grams(n), "rid long, met array<struct<bucket: long, n: long>>, grams binary")
    spread = sets.select("rid", F.col("met.bucket").alias("buckets"), F.explode("met").alias("m"), "grams")
    blocks = F.ceil(F.col("m.n") / TILE).cast("int")
    spread = spread.select("rid", "buckets", "grams", F.col("m.bucket").alias("bucket"), F.pmod(F.xxhash64("rid"), blocks).cast("int").alias("side"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    tiles = spread.select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "rid", "side", "buckets", "grams")
    tiles = tiles.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "rid")
    found = common.written(tiles.mapInArrow(_links(threshold), "rid long, links long, least long"), "found")
    labels = components(found.filter("rid <> least").select(F.col("rid").alias("a"), F.col("least").alias("b")))
    linked = found.groupBy("rid").agg(F.sum("links").alias("links"))
    labelled = texts.select("k1", "k2", F.col("text").alias("rid"), "copies").join(labels.withColumnRenamed("node", "rid"), "rid", "left").join(linked, "rid", "left")
    labelled = labelled.select("k1", "k2", "copies", F.col("copies").alias("n"), F.coalesce("component", "rid").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    placed = common.joined(signed.select("doc_id", "rid", "k1", "k2"), common.written(labelled, "labelled"), ["k1", "k2"], "n", "left")
    placed = placed.select("doc_id", "rid", F.coalesce("label", "rid").alias("label"), F.coalesce("links", F.lit(0).cast("long")).alias("links"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
    placed = common.written(placed, "placed")
    firsts = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"), F.count("*").alias("n"))
    classes = common.joined(placed, common.written(firsts, "firsts"), ["label"], "n")
    return classes.select("doc_id", "rid", F.col("first.doc_id").alias("class_id"), "links", "copies", (F.col("rid") == F.col("first.rid")).alias("chosen"))


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """The rows of docs that are their class's first; all columns stay."""
    rows, key = common.keyed(docs)
    chosen = near_duplicate_classes(rows, threshold, n, key=key).filter("chosen").select(F.col("rid").alias(key))
    return rows.join(chosen, key, "left_semi").drop(key)
