"""The registered queries over the smallest tables, against plain computations from their contracts."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tideline.llm import queries, tokens

import corpus_pipeline

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def plain():
    return tokens.Encoder().tokenizer


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_op1(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    expected = db.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.ORACLES['op1_top_k']})").fetchall()
    assert sorted(tuple(r)[:4] for r in run(spark, "op1_top_k")) == sorted(expected) and expected


def test_op2(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    urls = {r["page_id"]: r["url"] for r in pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "url"]).to_pylist()}
    got = run(spark, "op2_url_filter")
    assert len(got) == len(urls)
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else r.verdict) and r.verdict in ("allow", "block")


def test_op3(spark, docs, plain):
    whole, fill = {}, {}
    for r in run(spark, "op3_packing"):
        whole.setdefault(r.doc_id, []).append(r)
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d in docs:
        ids = [*plain.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        parts = sorted(whole[d["doc_id"]], key=lambda r: r.start)
        at = 0
        for r in parts:
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    sums = []
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sums.append(at)
    assert max(sums) <= 2048
    assert sum(0 if s & (s - 1) == 0 else 2048 - s for s in sums) <= 0.02 * sum(sums)


def test_op4(spark, docs):
    def split(t):
        return [w for w in WORD.findall((t or "").encode().lower())] + [None]

    def out(d):
        return zlib.crc32(str(d["doc_id"]).encode()) % 5 == 1

    c = Counter(w for d in docs if not out(d) for w in split(d["text"]))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in run(spark, "op4_language_model")}
    for d in docs:
        r, words = got[d["doc_id"]], split(d["text"])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(d), len(words), sum(c[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op5(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_language")}
    lang = {d["doc_id"]: d["lang"] for d in docs}
    held = [r for r in got.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got.values())
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op8(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    first = {}
    for p in pages:
        first[p["html"] or ""] = min(p["page_id"], first.get(p["html"] or "", p["page_id"]))
    expected = []
    for p in pages:
        data, of = (p["html"] or "").encode(), first[p["html"] or ""]
        expected.append((p["page_id"], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if of == p["page_id"] else "revisit", None if of == p["page_id"] else of))
    assert sorted(tuple(r) for r in run(spark, "op8_warc")) == sorted(expected)


def test_op9(spark, docs):
    seen, expected = set(), []
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        words = WORD.findall((d["text"] or "").encode())
        covered = set()
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                covered.update(range(k, k + 20))
            seen.add(window)
        kept = b" ".join(w for k, w in enumerate(words) if k not in covered)
        expected.append((d["doc_id"], len(words), len(covered), hashlib.sha256(kept).hexdigest()))
    assert sorted(tuple(r) for r in run(spark, "op9_substrings")) == expected


def test_op10(spark, docs, plain):
    at, expected = 0, []
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = [*plain.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        expected.append((d["doc_id"], at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in run(spark, "op10_token_files")) == expected


def test_pipeline(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = table
    counts = [kept.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        from tideline.llm import _common as common

        kept = common.written(stage(spark, kept, SF), "test-stage")
        assert kept.columns == table.columns
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True)
    left = {r.doc_id: r for r in kept.collect()}
    items = [r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    assert not any(i in r.text for i in items for r in left.values())
    assert all(r.n_chars == len(r.text) for r in left.values())
    texts = [r.text for r in left.values()]
    assert len(set(texts)) == len(texts)
    # Clean documents stay: those that share no window, are no copy, hold no item and have a letter.
    split = {d["doc_id"]: WORD.findall((d["text"] or "").encode()) for d in docs}
    grams = Counter()
    for w in split.values():
        grams.update(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    for d in docs:
        w = split[d["doc_id"]]
        clean = re.search(r"[^\W\d_]", d["text"] or "") and all(grams[tuple(w[k : k + 5])] == 1 for k in range(max(1, len(w) - 4))) and not any(i[:40] in d["text"] for i in items)
        if clean:
            assert left[d["doc_id"]].text == d["text"]
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)


def test_stages_without_rows(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
