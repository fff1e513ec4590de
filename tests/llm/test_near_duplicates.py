"""Near-duplicate classes and links against brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F
from tideline.llm import _common as common
from tideline.llm import near_duplicates as nd
from tideline.llm.components import components


def brute(rows, n=5, threshold=0.8):
    def grams(t):
        w = (t or "").encode().split()
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                label[max(find(i), find(j))] = min(find(i), find(j))
                if sets[i] != sets[j]:
                    links[i].add(sets[j])
                    links[j].add(sets[i])
    classes = {}
    for i, (d, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(d)
    ids = {k: min((d for d in v if d is not None), default=None) for k, v in classes.items()}
    return [(rows[i][0], ids[find(i)], len(links[i])) for i in range(len(rows))]


def make_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 5, 6, 80, 200, 300]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 3, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    hot = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(60):
        copy = list(hot)
        copy[rng.randrange(150)] = rng.choice(vocabulary)
        copy[rng.randrange(150)] = rng.choice(vocabulary)
        rows.append((len(rows), " ".join(copy)))
    rows += [(1000 + i, " ".join(hot)) for i in range(20)]
    return [*rows, (5, "twice five words are here now"), (5, "twice five words are here now"), (None, rows[0][1]), (None, "alone words"), (2000, None), (2001, ""), (2002, "\n")]


@pytest.mark.parametrize("tile", [256, 7])
def test_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(nd, "TILE", tile)
    rows = make_rows()
    df = spark.createDataFrame([(a, b, 1, "k") for a, b in rows], "doc_id long, text string, rid int, bucket string")
    got = nd.near_duplicate_classes(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.links) for r in got), key=str) == sorted(brute(rows), key=str)
    kept = nd.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.chosen for r in got)
    assert nd.near_duplicate_classes(df.limit(0)).collect() == []


def test_bands():
    bands, rows = nd.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 160


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 90)] + [(200 + i, 200) for i in range(1, 30)] + [(301, 300), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(91)) and all(got[200 + i] == 200 for i in range(30)) and got[301] == 300


def test_hot_keys_are_joined_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rows = [(i, 7 if i % 3 == 0 else i % 50 if i % 5 else None) for i in range(600)]
    left = spark.createDataFrame(rows, "i long, k long")
    right = left.groupBy("k").agg(F.min("i").alias("first"), F.count("*").alias("n")).filter("k is null or k % 2 = 1")
    inner = {(r.i, r.first) for r in left.join(right.drop("n"), "k").collect()}
    assert {(r.i, r.first) for r in common.joined(left, right, ["k"], "n").collect()} == inner
    plain = {(r.i, r.first) for r in left.join(right.drop("n"), "k", "left").collect()}
    assert {(r.i, r.first) for r in common.joined(left, right, ["k"], "n", "left").collect()} == plain
    star = [(0, i) for i in range(1, 200)] + [(i + 1000, i + 1001) for i in range(30)] + [(i, i + 500) for i in range(1, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert len(got) == 200 + 31 + 99 and all(c == (1000 if 1000 <= k <= 1030 else 0) for k, c in got.items())


def test_very_long_texts(spark):
    rng = random.Random(3)
    words = [f"v{rng.randrange(10**7)}" for _ in range(250_000)]
    near = list(words)
    near[1000:1100] = ["other"] * 100
    big = "y" * (3 << 19)
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join([big, *words[:9]])), (4, " ".join([big, *words[:9]]) + " "), (5, " ".join([big + "z", *words[:9]]))]
    got = nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.links) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 3, 0), (5, 5, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_components_against_brute_force(spark, seed, monkeypatch):
    """Chains of shuffled nodes, sparse random graphs and stars, in few rounds."""
    monkeypatch.setattr(common, "HOT_ROWS", 30)
    rng = random.Random(seed)
    nodes = rng.sample(range(10**6), 900)
    links = [(nodes[i], nodes[i + 1]) for i in range(300)]
    links += [(rng.choice(nodes[400:800]), rng.choice(nodes[400:800])) for _ in range(220)] + [(nodes[850], x) for x in nodes[800:900]]
    label = {x: x for x in nodes}
    for _ in range(400):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), rounds=12).collect()}
    assert got == {x: label[x] for x in {x for a, b in links if a != b for x in (a, b)}}
