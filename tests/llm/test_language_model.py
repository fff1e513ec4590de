"""Elias-Fano against plain arrays; the model against brute force in dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tideline.llm import language_model as lm
from tideline.llm.elias_fano import EliasFano, encode


@pytest.mark.parametrize("n,most", [(0, 1), (1, 5), (1000, 10), (1000, 1 << 50), (5000, 4000), (300, 1 << 62)])
def test_elias_fano(n, most):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, most, n, dtype=np.uint64))
    coded = EliasFano(encode(values))
    assert np.array_equal(coded.get(np.arange(n)), values)
    wanted = np.concatenate((values, rng.integers(0, most, 500, dtype=np.uint64)))
    got = coded.find(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), n))
    first = np.searchsorted(values, wanted)
    ok = (first < n) & (values[np.minimum(first, n - 1)] == wanted) if n else np.zeros(len(wanted), bool)
    assert np.array_equal(got, np.where(ok, first, -1))
    half = coded.find(wanted, np.full(len(wanted), n // 2), np.full(len(wanted), n))
    assert all(h == -1 or (h >= n // 2 and values[h] == w) for h, w in zip(half.tolist(), wanted.tolist(), strict=True))


def brute(rows):
    def split(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", t.encode())] + [None]

    def out(key):
        return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1

    count, pairs, triples = Counter(), defaultdict(Counter), defaultdict(Counter)
    for key, t in rows:
        if not out(key):
            words = split(t)
            count.update(words)
            for a, b, c in zip([None, None, *words], [None, *words], words, strict=False):
                pairs[b][c] += 1
                triples[a, b][c] += 1
    total, size = sum(count.values()), len(count)
    base = lambda w: (count[w] + 0.5) / (total + 0.5 * (size + 1))
    result = []
    for key, t in rows:
        words, score = split(t), 0.0
        for a, b, c in zip([None, None, *words], [None, *words], words, strict=False):
            p = base(c)
            for seen, off in ((pairs[b] if b in pairs else None, lm.DISCOUNT), (triples[a, b] if (a, b) in triples else None, lm.TRIPLE_DISCOUNT)):
                if seen:
                    n = sum(seen.values())
                    p = max(seen.get(c, 0) - off, 0) / n + off * len(seen) / n * p
            score += math.log10(p)
        result.append((key, out(key), len(words), sum(count[w] > 0 for w in words), total, sum(math.log10(base(w)) for w in words), score))
    return result


@pytest.mark.parametrize("parts", [None, 23])
def test_against_brute_force(spark, parts, monkeypatch):
    if parts:
        monkeypatch.setattr(lm, "ranges", lambda df, size: parts)
        monkeypatch.setattr(lm, "STRETCH", 200)
    rng = random.Random(5)
    words = [f"w{int(rng.expovariate(0.05))}" for _ in range(400)] + ["É", "​"]
    phrases = [[rng.choice(words) for _ in range(6)] for _ in range(40)]  # order that a model can learn
    rows = []
    for i in range(150):
        text, w = [], rng.choice(words)
        for _ in range(rng.choice([0, 1, 5, 60, 300])):
            w = "The" if w != "The" and rng.random() < 0.4 else rng.choice(words)
            text += rng.choice(phrases) if rng.random() < 0.2 else [w]
        rows.append((i, rng.choice([" ", "\n"]).join(text)))
    rows += [(3, "twice"), (3, "twice"), (None, "no id The w1"), (900, None), (901, "")]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, place int")
    got = sorted(map(tuple, lm.held_out_scores(df).collect()), key=str)
    expected = sorted(brute(rows), key=str)
    for g, e in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(expected, key=lambda r: (str(r[0]), r[2], r[5])), strict=True):
        assert g[:5] == e[:5]
        assert math.isclose(g[5], e[5], rel_tol=1e-9)
        assert abs(g[6] - e[6]) <= 0.03 * e[2] + 0.05  # 8-bit codes
    held = [(g[6], g[5]) for g in got if g[1]]
    assert sum(x for x, _ in held) > sum(x for _, x in held)
    assert lm.held_out_scores(df.limit(0)).collect() == []
    none = lm.held_out_scores(df.filter("crc32(cast(doc_id as string)) % 5 = 1")).collect()
    assert all(r.train_tokens == 0 and r.base_score == r.score for r in none)


def test_documents_that_occur_twice_score_apart(spark):
    """A training text that stands twice is more likely, by token, than one that stands once, and that than a new one."""
    rng = random.Random(9)
    draw = lambda: " ".join(f"w{int(rng.expovariate(0.01))}" for _ in range(80))
    learned = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 != 1]
    new = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 1][:50]
    once, twice, fresh = [draw() for _ in range(200)], [draw() for _ in range(50)], [draw() for _ in range(50)]
    texts = [("once", x) for x in once] + [("twice", x) for x in twice] * 2
    rows = [(d, k, x) for d, (k, x) in zip(learned, texts, strict=False)] + [(d, "new", x) for d, x in zip(new, fresh, strict=True)]
    kind = {d: k for d, k, _ in rows}
    got = lm.held_out_scores(spark.createDataFrame([(d, x) for d, _, x in rows], "doc_id long, text string")).collect()
    by = {k: [r.score / r.n_tokens for r in got if kind[r.doc_id] == k] for k in ("once", "twice", "new")}
    assert min(by["twice"]) > max(by["once"]) > min(by["once"]) > max(by["new"])


def test_very_long_texts_and_many_of_one_kind(spark, monkeypatch):
    """A pair that two bytes don't count, a word of several segments, a text of several runs."""
    monkeypatch.setattr(lm, "ranges", lambda df, size: 5)
    learned = [d for d in range(20) if zlib.crc32(str(d).encode()) % 5 != 1]
    rows = list(zip(learned, ("a b " * 150_000, "x" * (3 << 19) + " a b", "a c"), strict=False))
    got = sorted(map(tuple, lm.held_out_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    for g, e in zip(got, sorted(brute(rows)), strict=True):
        assert g[:5] == e[:5] and abs(g[6] - e[6]) <= 0.03 * e[2] + 0.05
