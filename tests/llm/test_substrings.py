"""Removal of repeated windows against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tideline.llm import _common as common
from tideline.llm import substrings


def brute(rows, n):
    first, out = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    words = [(b or "").encode().split() for _, b in rows]
    for i in order:
        covered = set()
        for k in range(len(words[i]) - n + 1):
            if tuple(words[i][k : k + n]) in first:
                covered.update(range(k, k + n))
            else:
                first[tuple(words[i][k : k + n])] = True
        out[i] = (len(words[i]), len(covered), b" ".join(w for k, w in enumerate(words[i]) if k not in covered).decode())
    return [(rows[i][0], *out[i]) for i in range(len(rows))]


@pytest.mark.parametrize("period", [1, 7, 13])
def test_cover(period):
    cover = substrings.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert period != 13 or len(cover) == 4


@pytest.mark.parametrize("n,period", [(20, 13), (8, 7)])
def test_against_brute_force(spark, n, period, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 300)
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(4000)] + ["é", "​x"]
    passages = [[rng.choice(vocabulary) for _ in range(k)] for k in (19, 20, 21, 33, 60)]
    rows = []
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 19, 20, 60, 200]))]
        for p in rng.sample(passages, rng.choice([0, 0, 1, 2])):
            words[rng.randint(0, len(words)) :] = p + words[:5]
        rows.append((i, "\n \t".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))))
    rows += [(200 + i, " ".join(["same"] * 45)) for i in range(5)] + [(300, rows[5][1]), (300, rows[5][1]), (None, rows[9][1]), (301, None), (302, "  "), (-4, rows[20][1])]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, rid int, places int")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(df, n, period, joined=True).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, n), key=str)
    cut = {r.rid: r for r in substrings.without_repeats(df, n, period).collect()}
    assert sorted(" ".join(x.decode() for x in r.kept.encode().split()) for r in cut.values()) == sorted(x[3] for x in got)
    assert substrings.without_repeats(df.limit(0), n, period).collect() == []


def test_windows_of_equal_sums_are_told_apart():
    """Two windows of one sum, made by moving a difference to the next word times the multiplier."""
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    for times in (0xA0761D6478BD642F, 0xD1342543DE82EF95):
        b = a.copy()
        b[18] += np.uint64(977)
        b[19] -= np.uint64(977) * np.uint64(times)
        x, y = substrings.window_hashes(a, 20), substrings.window_hashes(b, 20)
        assert (x[0] == y[0]).all() == (times == 0xA0761D6478BD642F)
        assert (x[1] != y[1]).all()




def test_a_constructed_collision_keeps_its_words(monkeypatch):
    """The operator's own steps on two documents whose windows agree in the first hash only."""
    n, period = 20, 13
    a = np.random.default_rng(5).integers(0, 1 << 63, n, dtype=np.uint64)
    b = a.copy()
    b[18] += np.uint64(977)
    b[19] -= np.uint64(977) * np.uint64(0xA0761D6478BD642F)
    names = {f"w{i}".encode(): x for i, x in enumerate(a)} | {f"v{i}".encode(): x for i, x in enumerate(b)}
    monkeypatch.setattr(common, "word_hashes", lambda joined, starts, ends: np.array([names[joined[x:y]] for x, y in zip(starts, ends, strict=True)], dtype=np.uint64))
    texts = [" ".join(f"{k}{i}" for i in range(n)) for k in "wv"]
    marks = np.zeros(1, "<u4").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([0, 1]), pa.array([0, 1]), pa.array([marks, marks], pa.binary())], ["text", "rid", "doc_id", "places"])
    sent = [(r["range"], r["data"]) for out in substrings._windows(n, period, 1)(iter([batch])) for r in out.to_pylist()]
    assert all(k >= 0 for k, _ in sent)  # no window is marked within the task
    merged = substrings._LaterWindows(1)
    assert not [r for out in merged.add([d for _, d in sent]) for r in out.to_pylist()]
    h1, *_ = substrings._unpack(substrings._WINDOW, [d for _, d in sent])
    assert len(h1) == 2 and h1[0] == h1[1]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_merged_in_pieces(seed):
    """A hot hash in every block: the same marks in one piece and in many, and one line kept of each hash."""
    rng = np.random.default_rng(seed)
    blocks = []
    for _ in range(40):
        h = np.unique(np.append(rng.integers(0, 200, 30), 7))
        order = rng.integers(0, 1000, len(h))
        blocks.append((h, order))

    def marks(made):
        out = set()
        for batch in made:
            for r in batch.to_pylist():
                out |= set(zip(*(x.tolist() for x in substrings._unpack(substrings._MARK, [r["data"]])), strict=True))
        return out

    for kind, start in ((substrings._ANCHOR, substrings._SharedAnchors), (substrings._WINDOW, substrings._LaterWindows)):
        data = []
        for k, (h, order) in enumerate(blocks):
            columns = [h, order, np.full(len(h), k)] if kind is substrings._ANCHOR else [h, h % 3, order, order, np.full(len(h), k)]
            data.append(substrings._pack(kind, columns))
        whole, parts = start(5), start(5)
        at_once = marks(whole.add(data))
        in_parts = marks(b for i in range(0, 40, 3) for b in parts.add(data[i : i + 3]))
        assert at_once == in_parts and len(parts.kept[0]) == len({x for h, _ in blocks for x in h.tolist()})
        want = {}
        for k, (h, order) in enumerate(blocks):
            for x, o in zip(h.tolist(), order.tolist(), strict=True):
                want.setdefault(x, []).append((o, k))
        lists = [sorted(v) for v in want.values() if len(v) > 1]
        assert at_once == {x for v in lists for x in (v if kind is substrings._ANCHOR else v[1:])}


def test_very_long_texts_and_words(spark):
    """Texts and words of several runs and segments, whole."""
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(30)]
    long = [f"q{rng.randrange(10**6)}" for _ in range(200_000)]
    long[150_000:150_000] = passage
    word = "x" * (3 << 19)
    rows = [(1, " ".join(passage)), (2, " ".join(long)), (3, " ".join([word, *passage, word + "y"])), (4, " ".join([word, *passage[:15]]))]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), joined=True).collect()]
    assert sorted(got) == sorted(brute(rows, 20))
