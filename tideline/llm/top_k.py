"""Exact top-k search by tiled matrix products.

Vectors travel as blocks of a binary matrix. Query blocks and candidate blocks meet on a grid: with G groups of queries
and L lanes of candidates, cell (g, l) gets the queries of group g and the candidates of lane l. G and L follow the
counts, so a cell's memory is bounded at any size. A cell multiplies tile by tile and keeps k per query at once; lists
of cells are then merged in a tree, per query. The queries are a stated set, searched against all rows; no pairs are
rows.

Products of whole numbers are exact: in 32-bit floats where every sum stays under 2**24, in 64-bit floats under 2**53,
and else in Python's integers (scores that a long can't hold are clipped to its range, components that a double can't hold after scaling to the greatest double).

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do rows without an id;
only vectors of equal length are compared; rows that repeat an id count once, with the best score, and never for a query
of that id; ties go to the smaller id; fewer than k candidates give fewer rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, bytes of candidates of a lane and of queries of a group (before the vectors' last block).
BLOCK, LANE_BYTES, GROUP_BYTES = 2048, 24 << 20, 8 << 20
#: Lists merged at once.
FAN_IN = 32
TILE = 512


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole-number doubles; finite ones that a double can't hold count as the greatest."""
    with np.errstate(over="ignore"):
        out = np.floor(scale * x.astype(np.float64))
    most = np.finfo(np.float64).max
    return np.where(np.isfinite(x), np.clip(out, -most, most), out)


def packed(rows: np.ndarray) -> bytes:
    """Whole numbers as 32-bit floats where these hold them, else as doubles."""
    return rows.astype("<f4" if np.abs(rows).max(initial=0) <= 1 << 24 else "<f8").tobytes()


def unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<f4" if len(data) == 4 * n * dim else "<f8").astype(np.float64).reshape(n, dim) if dim else np.zeros((n, 0))


BLOCK_SCHEMA = "dim int, n long, most double, ids binary, data binary"


def _blocks(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def give(dim: int) -> pa.RecordBatch:
            parts = held.pop(dim)
            ids, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            most = float(np.abs(rows).max(initial=0))
            values = [[dim], [len(ids)], [most], [ids.astype("<i8").tobytes()], [packed(rows)]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary()), strict=True)], ["dim", "n", "most", "ids", "data"])

        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.to_numpy(zero_copy_only=False)
            start = vectors.offsets.to_numpy()[:-1]
            for dim in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dim)
                rows = scaled(values[start[own][:, None] + np.arange(dim)], scale)
                good = np.isfinite(rows).all(axis=1)
                held.setdefault(dim, []).append((ids[own][good].astype(np.int64), rows[good]))
                while sum(len(p[0]) for p in held.get(dim, [])) >= BLOCK:
                    yield give(dim)
        for dim in list(held):
            if sum(len(p[0]) for p in held[dim]):
                yield give(dim)

    return run


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of scores the k best (ids, scores) by score, then smaller id, without the row's own id; an id that
    repeats counts once."""
    out = []
    repeats = len(np.unique(ids)) < len(ids)
    for row, me in zip(scores, own, strict=True):
        at = np.flatnonzero(ids != me)
        if not repeats and len(at) > k:
            edge = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= edge]
        at = at[np.lexsort((ids[at], ~row[at]))]
        if repeats:
            _, first = np.unique(ids[at], return_index=True)
            at = at[np.sort(first)]
        out.append((ids[at[:k]], row[at[:k]]))
    return out


def products(q: np.ndarray, c: np.ndarray, most: float) -> np.ndarray:
    """Exact products of whole-number rows; most: a bound on the components' product."""
    bound = most * max(1, q.shape[1])
    if bound < 1 << 24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (q @ c.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q) @ exact(c).T if q.size and c.size else np.zeros((len(q), len(c))), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _cell(k: int):
    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        def whole(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, float]:
            dim = key[0].as_py()
            ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows])
            return ids, np.concatenate([unpacked(r["data"], r["n"], dim) for r in rows]), max(r["most"] for r in rows)

        out: list[tuple] = []
        if len(queries) and len(candidates):
            q_ids, q, q_most = whole(queries.to_pylist())
            blocks = candidates.to_pylist()
            lane = key[2].as_py()
            for a in range(0, len(q), TILE):
                best: list[tuple[np.ndarray, np.ndarray]] = []
                for block in blocks:
                    ids, c, c_most = whole([block])
                    found = best_of(products(q[a : a + TILE], c, q_most * c_most), ids, q_ids[a : a + TILE], k)
                    best = found if not best else [_merged(x, y, k) for x, y in zip(best, found, strict=True)]
                for me, (ids, scores) in zip(q_ids[a : a + TILE].tolist(), best, strict=True):
                    out += zip([me] * len(ids), [lane] * len(ids), ids.tolist(), scores.tolist(), strict=True)
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "lane", "vec_id", "score"])

    return run


def _merged(x: tuple, y: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, scores = np.concatenate((x[0], y[0])), np.concatenate((x[1], y[1]))
    at = np.lexsort((ids, ~scores))
    _, first = np.unique(ids[at], return_index=True)
    at = at[np.sort(first)][:k]
    return ids[at], scores[at]


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that is_query holds for, the k best other rows by integer product."""
    usable = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()))
    usable = usable.withColumn("__query", F.coalesce(is_query, F.lit(False)))
    pick = [F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")]
    sizes = usable.agg(F.sum(F.size(vector) * 8.0).alias("all"), F.sum(F.when(F.col("__query"), F.size(vector) * 8.0)).alias("queries")).first()
    lanes = int((sizes["all"] or 0) // LANE_BYTES) + 1
    groups = int((sizes["queries"] or 0) // GROUP_BYTES) + 1
    candidates = usable.select(*pick).mapInArrow(_blocks(scale), BLOCK_SCHEMA)
    queries = usable.filter("__query").select(*pick).mapInArrow(_blocks(scale), BLOCK_SCHEMA)
    own = F.xxhash64("ids")
    candidates = candidates.withColumn("lane", F.pmod(own, F.lit(lanes)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = queries.withColumn("g", F.pmod(own, F.lit(groups)).cast("int")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    cells = queries.groupBy("dim", "g", "lane").cogroup(candidates.groupBy("dim", "g", "lane"))
    lists = cells.applyInArrow(_cell(k), "query_id long, lane long, vec_id long, score long")
    while True:
        lanes = -(-lanes // FAN_IN)
        lists = lists.withColumn("lane", F.pmod("lane", F.lit(lanes))).groupBy("query_id", "lane", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id", "lane").orderBy(F.col("score").desc(), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if lanes == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
