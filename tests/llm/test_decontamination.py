"""Planted leaks are found, clean documents stay, and the linear algebra agrees with direct computation."""

import random

import numpy as np
from tideline.llm import decontamination as dc


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 80))] for _ in range(2))
        assert dc.lcs_ends(a, b)[-1] == lcs(a, b)


def make(seed=1):
    rng = random.Random(seed)
    common_words = ["the", "of", "and", "in", "to", "a"]
    rare = [f"word{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(common_words) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items = [(100 + i, draw(rng.randint(15, 59))) for i in range(20)]
    docs, truth = [], set()
    for i in range(300):
        words = draw(rng.choice([5, 60, 400, 2500]))
        if i % 5 == 0:
            key, item = rng.choice(items)
            item = list(item)
            for _ in range(rng.choice([0, 0, len(item) // 12, len(item) // 6])):
                k = rng.randrange(len(item))
                item[k] = rng.choice(rare)
            at = rng.randint(0, len(words))
            words[at:at] = item
            truth.add((i, key))
        docs.append((i, (" ".join(words) + ".").capitalize()))
    return items, docs, truth


def test_planted(spark, monkeypatch):
    items, docs, truth = make()
    rows = [(*d, "x", 1) for d in docs] + [(None, " ".join(items[0][1]), "x", 1), (900, None, "x", 1), (901, "", "x", 1), (5, docs[5][1], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string, item long")
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(1, None), (2, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.leaks(df, table).collect()}
    assert got == truth | {(None, 100)}
    kept = dc.without_leaks(df, table)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got}
    monkeypatch.setattr(dc, "GROUP_ITEMS", 7)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(df, table).collect()} == got
    monkeypatch.setattr(dc, "ROUND_WORDS", 300)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(df, table).collect()} == got
    assert dc.leaks(df.limit(0), table).collect() == [] and dc.leaks(df, table.limit(0)).collect() == []


def test_sketch_is_exact(spark):
    items, docs, _ = make(3)
    vocabulary = {}
    for _, w in items:
        for x in w:
            vocabulary.setdefault(x.encode(), len(vocabulary))
    v = len(vocabulary)
    used = np.arange(0, v, 2)  # a group that uses half of the round's words
    local = np.full(v + 1, len(used), dtype=np.int32)
    local[used] = np.arange(len(used))
    df = spark.createDataFrame([(a, b, a) for a, b in docs[:40]], "doc_id long, text string, rid long")
    words = dc.encoded(df, vocabulary)
    weight, test = np.linspace(1, 2, len(used)), np.random.default_rng(1).standard_normal((len(used), 5))
    rows = []
    for _, text in docs[:40]:
        ids = [int(local[vocabulary.get(x, v)]) for x in dc.clean_words(text)]
        blocks = [ids[i : i + dc.BLOCK] for i in range(0, len(ids), dc.BLOCK)]
        # Passages: each block with the one before it, and with the one after it.
        for a, b in [*zip([[], *blocks], blocks, strict=False), *zip(blocks[-1:], [[]], strict=True)]:
            x = np.zeros(len(used))
            for i in [*a, *b]:
                if i < len(used):
                    x[i] += weight[i]
            rows.append(x)
    a = np.array(rows)
    assert np.allclose(dc.sketch(words, local, weight, test, "<u2"), a.T @ (a @ test), rtol=1e-3, atol=1e-2)
    found, blocks = dc.frequencies(words, v, "<u2")
    assert blocks == sum(-(-len(dc.clean_words(t)) // dc.BLOCK) for _, t in docs[:40]) and found.sum() > 0


def paraphrases(seed=6, n=72):
    """Items of 8 to 59 words of a topic; documents of that topic's words and others into which 0.55 to 0.75 of an item is
    put in order, the answer with it; and documents without any."""
    rng = random.Random(seed)
    everyday = [f"every{i}" for i in range(60)]
    topics = [[f"topic{t}word{i}" for i in range(80)] for t in range(12)]
    draw = lambda t, k: [rng.choice(everyday) if rng.random() < 0.5 else rng.choice(topics[t]) for _ in range(k)]
    items, docs, truth = [], [], set()
    for i in range(n):
        item = draw(i % 12, rng.randint(8, 59))
        tail = max(1, len(item) // 4)
        items.append((i, " ".join(item), " ".join(item[-tail:])))
        loose = sorted(range(len(item) - tail), key=lambda k: (item[k][:5] == "every", rng.random()))
        gone = set(loose[: len(item) - -(-len(item) * (56 + rng.randrange(15)) // 100)])  # a paraphrase keeps the everyday words
        placed = [rng.choice(topics[rng.randrange(12)]) if k in gone else w for k, w in enumerate(item)]
        words = draw(rng.randrange(12), 300)
        at = rng.randint(0, 300)
        words[at:at] = placed
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(draw(rng.randrange(12), rng.choice([1, 40, 400]))))]
    return items, docs


def exhaustive(items, docs):
    """Leaks by the checks alone, over every passage of every document for every item."""
    names = {}
    number = lambda text: [names.setdefault(w, len(names)) for w in dc.clean_words(text)]
    out = set()
    for d, text in docs:
        words = number(text)
        for i, item, answer in items:
            x, y = number(item), number(answer)
            for at in range(0, len(words), dc.BLOCK):
                if dc.verify(x, y, words[max(0, at - len(x)) : at + 2 * dc.BLOCK + len(x)]):
                    out.add((d, i))
                    break
    return out


def test_paraphrases_against_an_exhaustive_scan(spark):
    items, docs = paraphrases()
    truth = exhaustive(items, docs)
    assert len(truth) >= 60
    df, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, answer string")
    found = dc.leaks(df, table).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= truth and len(got) >= 0.95 * len(truth)
    assert sum(dc.PARAPHRASE <= r.share < dc.WHOLE for r in found) > 30


def test_the_latent_space_decides(spark):
    items, docs = paraphrases(9)
    df, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, answer string")
    pairs = {rank: {(r.doc_id, r.item_id): r.cosine for r in dc.leaks(df, table, rank=rank).collect()} for rank in (8, 36)}
    assert any(abs(pairs[8][k] - pairs[36][k]) > 0.05 for k in pairs[8].keys() & pairs[36].keys())
    high = {rank: {(r.doc_id, r.item_id) for r in dc.leaks(df, table, cosine=0.8, rank=rank).collect()} for rank in (8, 36)}
    assert high[8] != high[36]
    # Plain TF-IDF cosine of the same passages at the same floor misses some of what is found.
    vocabulary = sorted({w for _, x, _ in items for w in dc.clean_words(x)} | {w for _, x in docs for w in dc.clean_words(x)})
    number = {w: i for i, w in enumerate(vocabulary)}
    blocks = [(d, [number[w] for w in words[a : a + dc.BLOCK]]) for d, text in docs for words in [dc.clean_words(text)] for a in range(0, len(words), dc.BLOCK)]
    df_of = np.bincount(np.concatenate([np.unique(b) for _, b in blocks]), minlength=len(number))
    weight = np.log((1 + len(blocks)) / (1 + df_of)) + 0.1
    vector = lambda ids: np.bincount(ids, minlength=len(number)) * weight
    lexical = {}
    for i, item, _ in items:
        own = vector([number[w] for w in dc.clean_words(item)])
        for (d, a), (e, b) in zip(blocks, [*blocks[1:], (None, [])], strict=True):
            x = vector(a + (b if d == e else []))
            lexical[d, i] = max(lexical.get((d, i), 0), float(x @ own / np.linalg.norm(x) / np.linalg.norm(own)))
    assert any(lexical[k] < dc.COSINE for k in pairs[36])


def test_sums_of_groups():
    rng = np.random.default_rng(2)
    table, group = rng.standard_normal((50, 3)), np.sort(rng.integers(0, 9, 700) ** 3)
    at = rng.integers(0, 50, 700)
    names, sums = dc._group_sums(table, at, group)
    assert names.tolist() == sorted(set(group.tolist()))
    assert np.allclose(sums, [table[at[group == g]].sum(axis=0) for g in names])
    assert dc._group_sums(table, at[:0], group[:0])[1].shape == (0, 3)


def test_a_bound_of_words_in_common_loses_nothing():
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 12, 4000).astype(np.int32)
    items = [rng.integers(0, 12, n).tolist() for n in (4, 9, 30)]
    times = np.array([np.bincount(x, minlength=13) for x in items], dtype=np.uint16)
    low = rng.integers(0, 3900, 3000)
    high, item = low + rng.integers(1, 90, 3000), rng.integers(0, 3, 3000)
    need = np.array([dc._least(len(x)) for x in items])
    got = dc._possible(flat, low, high, item, times, need[item], 12)
    assert got.any() and not got.all()
    for k in range(3000):
        region = flat[low[k] : high[k]].tolist()
        assert got[k] or dc.lcs_ends(items[item[k]], region)[-1] < need[item[k]]


def test_paraphrases_and_short_items_among_unknown_words(spark):
    """Neighbours outside the benchmark's vocabulary have no direction in the latent space."""
    rng, fresh = random.Random(6), (f"other{i}" for i in range(10**6))
    items, docs, truth = [], [], set()
    for i in range(48):
        size = rng.randint(4, 15) if i < 24 else rng.randint(16, 59)
        item = [f"item{i}x{k}" for k in range(size)]
        items.append((i, " ".join(item), " ".join(item[-max(1, size // 4) :])))
        placed = list(item)
        if i % 2 and size >= 8:  # a paraphrase: 0.55 to 0.75 of the words stay in order, the answer's among them
            gone = rng.sample(range(size - size // 4), size - -(-size * 6 // 10))
            placed = [next(fresh) if k in gone else w for k, w in enumerate(item)]
        words = [next(fresh) for _ in range(400)]
        at = rng.randint(0, 400)
        words[at:at] = placed
        docs.append((i, " ".join(words)))
        truth.add((i, i))
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, answer string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth
    assert any(dc.PARAPHRASE <= r.share < dc.WHOLE for r in got)


def test_very_long_text(spark):
    """Items at and about the places where the parts of a long text meet."""
    rng = random.Random(12)
    items = [[f"i{k}w{rng.randrange(400)}" for _ in range(40)] for k in range(12)]
    words = [f"v{rng.randrange(5000)}" for _ in range(300_000)]
    step = 96_000 - dc.BLOCK
    places = [0, step - 41, step + 5, 2 * step - 20, 3 * step - 3, 150_000, 200_000, 299_000]
    for k, at in enumerate(places):
        words[at : at + 40] = items[k]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "x" * 2_000_000)], "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {r.item_id: (r.start, r.share) for r in dc.leaks(df, table).collect()}
    assert got == {k: (at, 1.0) for k, at in enumerate(places)}
