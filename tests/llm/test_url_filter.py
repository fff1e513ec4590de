"""Rules against plain Python, trees against held-out URLs of a known rule, and the defined cases."""

import random
import re

from tideline.llm import url_filter as uf


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = ["http://A.Example.ORG/es/1", "http://example.org/en/19", "http://example.org/en/2", "https://x.com/fr/", "https://x.com/de/1?q=/fr/", "http://org", "http://org/", "http://xorg/", "ftp://com/fr/x", "no url", "", None, "http://x.org?/es/", "http://ex\nample.org/es/\nb#c", "x://y.org://z/es/", "://org/", "http://É.COM/fr/a", "http://x.net/de/7"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.filter_urls(df).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert got[i][:3] == (host, path, rule), u
        assert got[i][3] == (verdict or got[i][3]) and got[i][3] in ("allow", "block")
    assert uf.filter_urls(df.limit(0)).collect() == []
    assert {r.verdict for r in uf.judged(df, uf.train(df.limit(0).withColumn("verdict", df.url)), ()).collect()} == {"allow"}


def test_trees_learn(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        bad = rng.random() < 0.4
        host = f"{'ads' if bad else 'news'}.{rng.choice(['bad-x.io', 'mix.net'] if bad else ['good.dev', 'mix.net'])}"
        path = "/".join(str(rng.randrange(10**9)) if bad else rng.choice(["story", "about", "item"]) for _ in range(rng.randint(1, 5 if bad else 3)))
        rows.append((i, f"https://{host}/{path}" + ("?a=1&b=2&c=3" if bad and rng.random() < 0.5 else ""), "block" if bad else "allow"))
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    model = uf.train(df.filter("page_id % 3 <> 0"))
    assert model.trees and uf._names(model.trees[0])
    got = uf.judged(df.filter("page_id % 3 = 0"), model, ()).collect()
    truth = {r[0]: r[2] for r in rows}
    assert sum(r.verdict == truth[r.page_id] for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_every_suffix_of_the_sample_counts_and_copies_are_weights(spark):
    """Labels that only the suffix tells apart, over many suffixes; a URL in a third of the rows doesn't fill the sample."""
    rng = random.Random(4)
    rows = [(f"http://h{rng.randrange(9)}.s{k}.net/x{rng.randrange(10**6)}", "block" if k % 2 else "allow") for k in range(900) for _ in range(12)]
    rows += [("http://hot.one.net/", "allow")] * 5000
    df = spark.createDataFrame(rows, "url string, verdict string")
    model = uf.train(df)
    assert model.suffixes.count() == 901
    fresh = spark.createDataFrame([(k, f"http://h3.s{k}.net/y{k}") for k in range(900)], "page_id long, url string")
    got = uf.judged(fresh, model, ()).collect()
    assert sum(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got) >= 0.95 * 900
    sample = uf._sampled(df, 3000).collect()
    assert len(sample) == len({r.url for r in sample}) == 3000
    assert sum(r.w for r in uf._sampled(df, 20_000).collect()) == len(rows)


def test_equally_long_rules_and_very_long_urls(spark):
    rules = (("allow", "b.a", "/x"), ("block", "a", "/xyz"), ("block", "a", "/x/"), ("allow", "c.b.a", "/"))
    long = "http://c.b.a/xyz/" + "q" * 200_000
    df = spark.createDataFrame([(1, "http://b.a/xyz"), (2, "http://b.a/x/"), (3, "http://c.b.a/xyz"), (4, long)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.filter_urls(df, rules).collect()}
    assert got == {1: ("b.a/x", "allow"), 2: ("b.a/x", "allow"), 3: ("c.b.a/", "allow"), 4: ("c.b.a/", "allow")}
    assert uf.filter_urls(df.withColumn("host", df.url).withColumn("f_suffix", df.url).withColumn("rule", df.url), rules).count() == 4
