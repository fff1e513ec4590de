"""The whole pipeline on a small table against plain Python for each stage."""

import random
import sys
from pathlib import Path

import corpus_pipeline
import numpy as np
from tideline.llm import packing, tokens

sys.path.insert(0, str(Path(__file__).parent))
import test_decontamination as leaks  # noqa: E402
import test_near_duplicates as near  # noqa: E402
import test_substrings as repeats  # noqa: E402


def fixture(seed=5):
    rng = random.Random(seed)
    kinds = {"aa": "ka lo mi nu ra te".split(), "bb": "sch ung ach ein zu orf".split()}
    words = {k: ["".join(rng.choice(v) for _ in range(rng.randint(2, 4))) for _ in range(1500)] for k, v in kinds.items()}
    draw = lambda k, n: [rng.choice(words[k]) for _ in range(n)]
    items = [(i, " ".join(draw("aa" if i % 2 else "bb", rng.randint(15, 50)))) for i in range(14)]
    passages = [draw("aa", 40) for _ in range(4)]
    rows, n = [], 0
    for i in range(160):
        lang = rng.choice(sorted(kinds))
        text = draw(lang, rng.choice([30, 90, 250]))
        if i % 6 == 0:
            text[rng.randint(0, len(text)) :] = rng.choice(passages) + text[:3]
        if i % 9 == 1:
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(items)[1].split()
        rows.append((n, " ".join(text), lang))
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            n += 1
            copy = list(text)
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = rng.choice(words[lang])
            rows.append((n, " ".join(copy), lang))
        n += 1
    return [*rows, (n, None, "aa"), (n + 1, "", None), (n + 2, "12 34 !", "bb"), (n + 3, rows[3][1], None)], items


def test_against_plain_python(spark, tmp_path):
    rows, items = fixture()
    docs = spark.createDataFrame([(*r, f"s{r[0] % 3}", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [(d, t) for d, t, _ in rows if t and any(c.isalpha() for c in t)]  # language: all are of learned ones
    classes = near.brute(kept)
    kept = [r for r, (d, first, _) in zip(kept, classes, strict=True) if d == first]
    kept = [(d, text) for d, n_words, n_removed, text in repeats.brute(kept, 20) if n_removed < n_words]
    leaked = {d for d, _ in leaks.exhaustive([(k, x, " ".join(x.split()[-max(1, len(x.split()) // 4) :])) for k, x in items], kept)}
    want = {d: text.split() for d, text in kept if d not in leaked}
    assert leaked and len(want) < len(kept) < len(classes)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns
    got = {r.doc_id: r for r in docs.collect()}
    assert {d: r.text.split() for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    encode = tokens.Encoder().tokenizer
    pieces = {}
    for r in packing.pack(docs).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {d: [i for _, x in sorted(p) for i in x] for d, p in pieces.items()} == {d: [*encode.encode(r.text, add_special_tokens=False).ids, 1] for d, r in got.items()}
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in run} == set(want) and sum(r.length for r in run) == sum(len(i) for p in pieces.values() for _, i in p)
