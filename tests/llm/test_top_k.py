"""Top-k lists against brute force in Python integers."""

import math
import random

import pytest
from pyspark.sql import functions as F
from tideline.llm import top_k


def brute(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % 5 == 0}):
        best = {}
        for i, v in good:
            if i == q:
                continue
            for j, u in good:
                if j == q and len(u) == len(v):
                    product = sum(a * b for a, b in zip(u, v, strict=True))
                    best[i] = max(best.get(i, -(1 << 63)), min(max(product, -(1 << 63)), (1 << 63) - 1))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k])]
    return out


@pytest.mark.parametrize("scale,lane", [(1, 24 << 20), (1e4, 3000), (1e9, 3000)])
def test_against_brute_force(spark, scale, lane, monkeypatch):
    monkeypatch.setattr(top_k, "LANE_BYTES", lane)
    monkeypatch.setattr(top_k, "GROUP_BYTES", lane // 2)
    rng = random.Random(1)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.5]) * scale for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(15)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (7, rows[9][1]), (500, None), (505, [1.0, None, 2.0]), (510, [float("nan")] * 8), (515, [float("inf")] * 8), (520, [1.0, 2.0]), (521, [2.0, 2.0]), (None, rows[0][1]), (525, [])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "vec_id long, embedding array<double>, lane int, g string")
    got = top_k.search(df, F.col("vec_id") % 5 == 0, k=10)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 10))
    assert top_k.search(df.limit(0), F.col("vec_id") % 5 == 0).collect() == []
