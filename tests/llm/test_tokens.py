"""Encoding, Simple-8b files and packing against the plain tokenizer."""

import random
import zlib

import numpy as np
import pytest
from tideline.llm import packing, token_files, tokens

SCHEMA = "doc_id long, text string, rid string, ids int"


@pytest.fixture(scope="module")
def plain():
    return tokens.Encoder().tokenizer


def texts():
    rng = random.Random(3)
    letters = [" ", " ", "\n", "\t", "a", "B", "1", ".", "!", "'s", "é", "\x1c", "​", "\x85", "ß", "<|endoftext|>"]
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    return ["", "a  b", " \n b", "a\n b\n\nc", "don't 've", "x   ", *odd]


def test_encoder_equals_library(plain):
    every = texts()
    encode = tokens.Encoder(most=50)
    assert [x.tolist() for x in encode(every)] == [x.ids for x in plain.encode_batch(every, add_special_tokens=False)]


def documents(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha.", "beta", "Gamma,", "délta!", "x"]) for _ in range(rng.choice([0, 3, 40, 900, 9000])))) for i in range(60)]
    rows += [(7, "again"), (7, "again"), (None, "no id"), (61, None), (62, "")]
    rng.shuffle(rows)
    return rows, spark.createDataFrame([(a, b, "x", 1) for a, b in rows], SCHEMA)


@pytest.mark.parametrize("high", [1, 2, 17, 60000, 1 << 40, 1 << 62])
def test_simple8b(high):
    rng = np.random.default_rng(high % 97)
    for n in (0, 1, 59, 1023, 1024, 1025, 5000):
        ids = rng.integers(0, high, n, dtype=np.uint64)
        ids[:: max(1, n // 7)] = 0
        words, firsts, escaped = token_files.encode(ids)
        assert np.array_equal(token_files.decode(words, firsts, escaped, n), ids)
    assert len(token_files.encode(np.zeros(600, dtype=np.uint64))[0]) == 10


def test_round_trip(spark, plain):
    rows, df = documents(spark)
    got = token_files.round_trip(df).collect()
    assert len(got) == len(rows)
    expected = sorted(((a, zlib.crc32(np.array([*plain.encode(b or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes())) for a, b in rows), key=str)
    assert sorted(((r.doc_id, zlib.crc32(r.ids)) for r in got), key=str) == expected
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got][0] is None and [r.doc_id for r in got][1:] == sorted(r.doc_id for r in got[1:])
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    assert token_files.round_trip(df.limit(0)).collect() == []


@pytest.mark.parametrize("size,stretch", [(2048, 1 << 18), (64, 500)])
def test_packing(spark, plain, size, stretch):
    rows, df = documents(spark)
    got = packing.pack(df, size=size, stretch=stretch).collect()
    whole, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert 0 < len(ids) <= size
        whole.setdefault(r.doc_id, []).append((r.start, r.doc_tokens, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, len(ids)))
    single = {a: b for a, b in rows if a not in (7,)}
    for a, b in single.items():
        parts = sorted(whole[a])
        assert [i for _, _, ids in parts for i in ids] == [*plain.encode(b or "", add_special_tokens=False).ids, 1]
        assert {n for _, n, _ in parts} == {sum(len(x) for _, _, x in parts)}
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    fills = [sum(n for _, n in x) for x in sequences.values()]
    padding = sum(0 if f & (f - 1) == 0 else size - f for f in fills)
    assert padding < (0.01 if size == 2048 else 0.2) * sum(fills) + 8 * size
    assert packing.pack(df.limit(0)).collect() == []


def test_windows_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        size = int(rng.integers(5, 40))
        points = np.concatenate(([0], np.cumsum(rng.integers(1, 5, 30))))
        prices = rng.integers(0, 9, 31)
        prices[0] = 0
        best = [0]
        for k in range(1, 31):
            best.append(min(best[i] + size - (points[k] - points[i]) + prices[k] for i in range(k) if points[k] - points[i] <= size))
        cuts = packing.windows(points, prices, size)
        assert sum(size - (b - a) + prices[list(points).index(b)] for a, b in zip(cuts, cuts[1:], strict=False)) == best[-1]


def test_stretches_lose_nothing_against_one_plan(monkeypatch):
    """Cuts placed stretch by stretch are those of a plan of all tokens at once; with less patience a few more windows."""
    monkeypatch.setattr(packing, "PATIENCE", 30)
    rng = np.random.default_rng(11)
    for trial in range(12):
        sizes = rng.choice([3, 40, 900, 5000], 250, p=[0.3, 0.4, 0.25, 0.05]) + rng.integers(0, 30, 250)
        is_end = np.zeros(100, dtype=bool)
        is_end[:7] = True
        ids = [rng.integers(0, 100, n).astype(np.uint32) for n in sizes]

        def placed(stretch, ids=ids, is_end=is_end):
            out, rows = packing._Stretch(512, is_end, 0, stretch), []
            for i, x in enumerate(ids):
                rows += out.add(i, x)
            return rows + list(out.place(last=True))

        one, many = placed(1 << 40), placed(6000)
        assert one == many, trial
        with monkeypatch.context() as m:
            m.setattr(packing, "PATIENCE", 2)
            assert len({r[3] for r in placed(6000)}) <= 1.05 * len({r[3] for r in one})


def test_long_unbroken_strings_are_not_kept(tmp_path):
    encode = tokens.Encoder()
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcdefgh0123") for _ in range(3000)) for _ in range(20)) + " word"]
    ids = encode(texts)[0]
    assert ids.tolist() == encode.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert all(len(k) <= tokens.LONGEST for k in [*encode.first, *encode.later]) and "word" in encode.later
