"""Language identification by nearest centroids of TF-IDF character n-grams.

A text's vector has the counts of its character n-grams (1 to 3 bytes of lower-cased letters, hashed to DIMENSIONS
places), damped by a logarithm, weighted by inverse document frequency and scaled to length 1. Each language has several
centroids, found by spherical k-means among its own texts. A text gets the language of the centroid with the greatest
cosine. It is rejected if it is farther from that centroid than nearly all learned texts of its length: each centroid has
a floor for each length class (a power of two of n-grams), SLACK times the QUANTILE of the cosines that whole sample
texts and fragments of them have with it.

The model is fitted on at most `most` labelled texts (a documented bound), an equal number for each language, taken in
the order of a hash of the id; every text is then classified whole, in one pass without a shuffle.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected; with no labelled text at all
every text is; of equal cosines the language first by name wins; of more than `most` languages those with the most texts
are learned. Rows with null or repeated ids are classified like others; very long texts are counted whole, in runs.
Columns of the input that are called like a result's are replaced by it; others stay untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import _common as common

UNDETERMINED = "und"
DIMENSIONS = 1 << 13
#: Labelled texts that a model is fitted on, at most.
SAMPLE = 4000
CENTROIDS = 3
#: Share of learned texts and fragments of a length under whose cosine a floor lies, and the floor's part of that cosine.
QUANTILE, SLACK = 0.005, 0.75
#: Length classes, and the fewest texts that give a centroid a floor of its own for a class.
CLASSES, FEWEST = 24, 40
RESULTS = ("lang_pred", "score", "rejected")

_FOLD = np.full(256, 0x20, dtype=np.uint32)
for _b in range(256):
    if 0x41 <= _b <= 0x5A:
        _FOLD[_b] = _b + 32
    elif 0x61 <= _b <= 0x7A or _b >= 0x80:
        _FOLD[_b] = _b


@dataclass
class Model:
    """Languages by row of centroids, inverse document frequencies, centroids of length 1, their floors by length class."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray


def counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of a lower-cased text; anything but letters counts as one space."""
    data = np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)
    out = np.zeros(DIMENSIONS, dtype=np.int64)
    for a in range(0, len(data), 1 << 20):
        x = _FOLD[data[a : a + (1 << 20) + 2]]
        x = x[np.concatenate(([True], (x[1:] != 0x20) | (x[:-1] != 0x20)))]
        own = len(x) if a + (1 << 20) >= len(data) else len(x) - 2
        pair = x[:-1] * np.uint32(257) + x[1:]
        triple = pair[:-1] * np.uint32(257) + x[2:]
        for k, grams in enumerate((x, pair, triple)):
            hashed = (grams[:own] + np.uint32(k * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            out += np.bincount(hashed >> np.uint32(32 - 13), minlength=DIMENSIONS)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def vectors(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(table).astype(np.float32) * idf)


def length_class(total: int) -> int:
    """The class of a text by its number of n-grams."""
    return min(CLASSES - 1, int(total).bit_length())


def _fragments(text: str) -> Iterator[str]:
    """Runs of 1, 2, 4 ... words of a text, each from a place that a hash of the text chooses; they only set floors."""
    words = text.split()
    size, place = 1, zlib.crc32(text.encode())
    while size < len(words):
        at = place % (len(words) - size + 1)
        yield " ".join(words[at : at + size])
        size, place = 2 * size, place * 69069 + 1 & 0xFFFFFFFF


def _sample(labelled: DataFrame, most: int) -> DataFrame | None:
    """key, text and lang of at most `most` usable rows, as many for each language as for others that have as many."""
    usable = labelled.filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    if not sizes:
        return None
    each = max(1, most // len(sizes))
    # Rows under twice the share that is wanted go to the exchange; the first `each` of those by hash are taken.
    bound = F.create_map(*(x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, (2 * each + 50) / r.n)))))
    hashed = usable.withColumn("h", F.xxhash64("key")).withColumn("p", bound[F.col("lang")])
    some = hashed.filter(F.col("p").isNotNull() & ((F.col("h") / F.lit(2.0**64) + 0.5) <= F.col("p"))).select("key", "text", "lang", "h")
    order = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    return some.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= each).select("key", "text", "lang")


def fit(labelled: DataFrame, most: int = SAMPLE, centroids: int = CENTROIDS, rounds: int = 8) -> Model:
    """Fits on labelled (text, lang, and `key` by whose hash the sample is taken). Rows without text, letter or lang are
    left out. Texts are vectorised on the executors; the driver holds at most `most` rows of counts, and those of their
    fragments, sparse."""
    common.bounded_batches(labelled.sparkSession)
    schema = "key string, lang string, whole boolean, places binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 16):
                rows = []
                for key, text, lang in zip(*(batch.column(k).slice(a, 16).to_pylist() for k in range(3)), strict=True):
                    for i, x in enumerate((text, *_fragments(text))):
                        if i == 0 or any(map(str.isalpha, x)):
                            found = counts(x)
                            places = np.flatnonzero(found)
                            rows.append((key, lang, i == 0, places.astype("<u2").tobytes(), found[places].astype("<u4").tobytes()))
                kinds = [pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "lang", "whole", "places", "counts"])

    sample = _sample(labelled, most)
    rows = [] if sample is None else sorted(sample.mapInArrow(run, schema).toLocalIterator(), key=lambda r: (r.lang, r.key or "", r.places))
    if not rows:
        return Model([], np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros((0, CLASSES)))
    df, parts = np.zeros(DIMENSIONS), [(r.lang, r.whole, np.frombuffer(r.places, "<u2"), np.frombuffer(r.counts, "<u4")) for r in rows]
    texts = [(lang, places, values) for lang, whole, places, values in parts if whole]
    for _, places, _ in texts:
        df[places] += 1
    idf = (np.log((1 + len(texts)) / (1 + df)) + 1).astype(np.float32)
    names, found = [], []
    for lang in sorted({x for x, _, _ in texts}):
        own = [(p, c) for x, p, c in texts if x == lang]
        mine = [_sparse_unit(p, c, idf) for p, c in own]
        centres = _clusters(mine, min(centroids, len(mine)), rounds)
        names += [lang] * len(centres)
        found.append(centres)
    table = np.concatenate(found).astype(np.float32)
    return Model(names, idf, table, _floors([(p, c) for _, _, p, c in parts], idf, table))


def _floors(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Floors by centroid and length class, from learned texts and fragments. A centroid with few of a length has the
    floor of all centroids for it; a length that few have, that of the next shorter one."""
    nearest, kinds, cosine = [], [], []
    for places, values in rows:
        at, x = _sparse_unit(places, values, idf)
        c = centroids[:, at] @ x
        nearest.append(int(np.argmax(c)))
        kinds.append(length_class(int(values.sum())))
        cosine.append(float(c.max()))
    near, kind, cos = np.array(nearest), np.array(kinds), np.array(cosine)
    out = np.zeros((len(centroids), CLASSES))
    for k in range(CLASSES):
        out[:, k] = out[:, k - 1] if k else 0.0
        if (kind == k).sum() >= FEWEST:
            out[:, k] = SLACK * np.quantile(cos[kind == k], QUANTILE)
        for j in range(len(centroids)):
            own = cos[(kind == k) & (near == j)]
            if len(own) >= FEWEST:
                out[j, k] = SLACK * np.quantile(own, QUANTILE)
    return out


def _sparse_unit(places: np.ndarray, values: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.log1p(values.astype(np.float32)) * idf[places]
    return places.astype(np.int64), x / max(float(np.linalg.norm(x)), 1e-12)


def _clusters(rows: list[tuple[np.ndarray, np.ndarray]], k: int, rounds: int) -> np.ndarray:
    """Spherical k-means from rows spread over the order of their size."""
    order = sorted(range(len(rows)), key=lambda i: len(rows[i][0]))
    centres = np.zeros((k, DIMENSIONS), dtype=np.float64)
    for j in range(k):
        places, x = rows[order[(2 * j + 1) * len(rows) // (2 * k)]]
        centres[j, places] = x
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        for places, x in rows:
            sums[int(np.argmax(centres[:, places] @ x)), places] += x
        sums[~sums.any(axis=1)] = centres[~sums.any(axis=1)]
        sums = unit(sums)
        if np.allclose(sums, centres):
            break
        centres = sums
    return centres


def identify(df: DataFrame, model: Model, results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """df with columns lang_pred, score (0 to 1: cosine of the nearest centroid) and rejected, or as `results` calls them;
    df has a column text. A column of df of such a name is replaced."""
    common.bounded_batches(df.sparkSession)
    spark = df.sparkSession
    df = df.drop(*(c for c in df.columns if c.lower() in results))
    shared = spark.sparkContext.broadcast(model)
    names = [f.name for f in df.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                texts = part.column(names.index("text")).to_pylist()
                some = [i for i, x in enumerate(texts) if x and m.languages and any(map(str.isalpha, x))]
                pred, score, rejected = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
                if some:
                    table = np.stack([counts(texts[i]) for i in some])
                    cosine = vectors(table, m.idf) @ m.centroids.T
                    for i, j, c, size in zip(some, cosine.argmax(axis=1).tolist(), cosine.max(axis=1).tolist(), table.sum(axis=1).tolist(), strict=True):
                        pred[i], score[i], rejected[i] = m.languages[j], min(1.0, max(0.0, c)), c < m.floors[j, length_class(size)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*names, *results])

    schema = StructType(list(df.schema.fields))
    for name, kind in zip(results, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning; a null id counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3 == 1


def fitted(docs: DataFrame, most: int = SAMPLE) -> Model:
    """A model of the documents that aren't held out, from their texts and langs."""
    labelled = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("string").alias("key"), "text", "lang")
    return fit(labelled, most)
