"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for all other URLs.

Everything is DataFrame expressions. Features are built-in functions of the URL. Training is boosting on histograms:
each level of a tree is one aggregation of gradients by node, feature and bin over a bounded, written sample, and the
driver reads those few sums and picks the splits; after each tree the sample is written with its new margins, so no plan
grows. The finished trees are one expression and suffix statistics a table of at most as many rows as the sample, so
judging URLs is a scan with a broadcast join.

The sample is `most` distinct labelled URLs with the number of rows of each as its weight, by the order of a hash, taken
after a filter by hash that leaves about four times as many rows, so nothing large is sorted or exchanged.

Defined cases: a URL that is null or has no `://` has empty host and path, no rule, and the model's verdict on empty
features; with no labelled URL, or labels of one class only, every unruled URL gets that class, or `allow` without any;
of rules equally long that fit, the one with the longer host decides. Very long URLs are taken whole. Rows that repeat
are judged alike. Only page_id and url are read, so columns of other names clash with nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Labelled URLs that a model is trained on, at most. All their suffixes keep their statistics.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, SMOOTH = 8, 3, 12, 0.4, 8.0


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits a host (or a domain above it) and the path's start; null if none.
    Of rules equally long the one with the longer host wins."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1])), reverse=True):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features as doubles, all finite."""
    url = F.coalesce(url, F.lit(""))
    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    chars = F.split(url, "")
    share = F.transform(F.array_distinct(chars), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    out = {
        "length": F.length(url),
        "host_length": F.length(host),
        "labels": F.when(host == "", 0).otherwise(F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1),
        "depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "path_length": F.length(path),
        "digits": _count(url, "[0-9]") / n,
        "marks": _count(url, "[^0-9A-Za-z]") / n,
        "hyphens": _count(host, "-"),
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "fragment": F.when(url.contains("#"), 1).otherwise(0),
        "entropy": entropy,
        "first_length": F.coalesce(F.length(F.try_element_at(F.split(path, "/"), F.lit(2))), F.lit(0)),
        "secure": F.when(F.translate(url, UPPER, LOWER).startswith("https:"), 1).otherwise(0),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


@dataclass
class Model:
    """Boosted trees over named features; a tree is nested (feature, edge, left, right) with numbers as leaves."""

    base: float
    trees: list = field(default_factory=list)
    suffixes: DataFrame | None = None  # suffix, share: at most as many rows as the sample
    suffix_default: float = 0.5

    def with_suffix_score(self, df: DataFrame, suffix: Column, name: str) -> DataFrame:
        """df with the suffix's share of blocked training URLs, smoothed; the whole share for one that wasn't seen."""
        if self.suffixes is None:
            return df.withColumn(name, F.lit(self.suffix_default))
        table = self.suffixes.select(F.col("suffix").alias(f"{name}_key"), F.col("share").alias(f"{name}_share"))
        found = df.withColumn(f"{name}_of", suffix).join(F.broadcast(table), F.col(f"{name}_of") == F.col(f"{name}_key"), "left")
        return found.withColumn(name, F.coalesce(f"{name}_share", F.lit(self.suffix_default))).drop(f"{name}_of", f"{name}_key", f"{name}_share")

    def margin(self, values: dict[str, Column]) -> Column:
        """Log-odds of block."""

        def leaf(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, edge, left, right = node
            return F.when(values[name] <= edge, leaf(left)).otherwise(leaf(right))

        out = F.lit(float(self.base))
        for tree in self.trees:
            out = out + leaf(tree)
        return out


def _sampled(labelled: DataFrame, most: int) -> DataFrame:
    """url, y (1 for block) and w (rows) of at most `most` distinct labelled URLs, in the order of a hash."""
    rows = labelled.filter("url is not null and verdict in ('allow', 'block')").select("url", (F.col("verdict") == "block").cast("double").alias("y"))
    n = rows.count()
    share = min(1.0, 4 * most / max(n, 1))
    some = rows.filter(F.xxhash64("url") / F.lit(2.0**64) + 0.5 <= share) if share < 1 else rows
    return some.groupBy("url", "y").agg(F.count("*").cast("double").alias("w")).orderBy(F.xxhash64("url"), "url", "y").limit(most)


def train(labelled: DataFrame, most: int = SAMPLE) -> Model:
    """Trains on labelled URLs (url, verdict `allow` or `block`), at most `most` distinct ones, weighed by their rows."""
    sample = _sampled(labelled, most).select("url", "y", "w", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    columns = features(F.col("url"), F.col("host"), F.col("path"))
    sample = common.written(sample.select("y", "w", suffix_of(F.col("host")).alias("last_labels"), *(v.alias(k) for k, v in columns.items())), "url-sample")
    sums = sample.agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("b")).first()
    if not sums.n or sums.b in (0, sums.n):
        return Model(base=-1.0 if not sums.b else 1.0)
    share = sums.b / sums.n
    of_suffix = sample.groupBy(F.col("last_labels").alias("suffix")).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("b"))
    of_suffix = of_suffix.select("suffix", ((F.col("b") + SMOOTH * share) / (F.col("n") + SMOOTH)).alias("share"))
    model = Model(math.log(share / (1 - share)), [], common.written(of_suffix, "url-suffixes"), share)
    names = [*columns, "suffix"]
    data = model.with_suffix_score(sample, F.col("last_labels"), "suffix").drop("last_labels")
    cuts = data.agg(*(F.percentile(F.col(c), F.array(*(F.lit(i / BINS) for i in range(BINS + 1)))).alias(c) for c in names)).first()
    # Edges lie halfway between neighbouring quantiles: a value that training didn't show goes with the nearer side.
    edges = {}
    for c in names:
        at = sorted(set(cuts[c]))
        edges[c] = [(a + b) / 2 for a, b in zip(at, at[1:], strict=False)]
    # A row becomes its bins; rows with equal bins and label are one row with their weight. The sample is bounded, so one
    # partition holds it and levels need no exchange.
    bins = {c: sum((F.when(F.col(c) > e, 1).otherwise(0) for e in edges[c]), F.lit(0)) for c in names}
    data = data.select("y", "w", *(b.alias(c) for c, b in bins.items())).groupBy("y", *names).agg(F.sum("w").alias("w"))
    data = common.written(data.withColumn("m", F.lit(float(model.base))).coalesce(1), "url-bins")
    values = {c: F.col(c).cast("double") for c in names}
    for k in range(TREES):
        p = 1 / (1 + F.exp(-F.col("m")))
        graded = data.coalesce(1).select(*names, (F.col("w") * (F.col("y") - p)).alias("g"), (F.col("w") * p * (1 - p)).alias("h"))
        tree = _grow(graded, names, edges, values)
        model.trees.append(_with_edges(tree, edges))
        if k + 1 < TREES:
            grown = Model(0.0, [tree]).margin(values)
            data = common.written(data.coalesce(1).withColumn("m", F.col("m") + grown), "url-margins")
    return model


def _grow(graded: DataFrame, names: list[str], edges: dict, values: dict[str, Column]):
    """One tree on bins, a level at a time. A split's sums give its children's, so the leaves need no level of their own."""
    splits: dict[int, tuple] = {}
    sums_of: dict[int, tuple[float, float]] = {}
    open_ = {1}
    for level in range(DEPTH):
        place = F.lit(1)
        for _ in range(level):
            step = None
            for k, s in splits.items():
                low = F.when(values[s[0]] <= s[1], 2 * k).otherwise(2 * k + 1)
                step = F.when(place == k, low) if step is None else step.when(place == k, low)
            place = place if step is None else step.otherwise(place)
        long = graded.select(place.alias("node"), "g", "h", F.posexplode(F.array(*(F.col(c) for c in names))).alias("f", "b"))
        if level:
            long = long.filter(F.col("node").isin(sorted(open_)))
        sums: dict[int, dict[str, dict[int, tuple[float, float]]]] = {}
        for r in long.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            sums.setdefault(r.node, {}).setdefault(names[r.f], {})[r.b] = (r.g, r.h)
        open_ = set()
        for node, by in sorted(sums.items()):
            g, h = (math.fsum(x[i] for x in by[names[0]].values()) for i in (0, 1))
            sums_of.setdefault(node, (g, h))
            best = None
            for name in names:
                lg = lh = 0.0
                for b in range(len(edges[name])):
                    lg, lh = lg + by[name].get(b, (0, 0))[0], lh + by[name].get(b, (0, 0))[1]
                    if lh < 1 or h - lh < 1:
                        continue
                    gain = lg**2 / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g**2 / (h + 1)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, name, b, lg, lh)
            if best:
                splits[node] = (best[1], best[2])
                sums_of[2 * node], sums_of[2 * node + 1] = (best[3], best[4]), (g - best[3], h - best[4])
                open_ |= {2 * node, 2 * node + 1}
        if not open_:
            break

    def build(k: int):
        if k in splits:
            return (*splits[k], build(2 * k), build(2 * k + 1))
        g, h = sums_of.get(k, (0.0, 0.0))
        return RATE * g / (h + 1)

    return build(1)


def _with_edges(tree, edges: dict):
    """The tree on values in the place of bins."""
    if not isinstance(tree, tuple):
        return tree
    name, b, left, right = tree
    return (name, edges[name][b], _with_edges(left, edges), _with_edges(right, edges))


def judged(pages: DataFrame, model: Model, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, verdict and score (the model's probability of block)."""
    base = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    values = features(F.col("url"), F.col("host"), F.col("path"))
    used = sorted({n for t in model.trees for n in _names(t)})
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"), *(values[n].alias(f"f_{n}") for n in used if n in values))
    if "suffix" in used:
        base = model.with_suffix_score(base, suffix_of(F.col("host")), "f_suffix")
    margin = model.margin({n: F.col(f"f_{n}") for n in used})
    base = base.withColumn("score", 1 / (1 + F.exp(-margin)))
    return base.select("page_id", "url", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")


def _names(tree) -> set[str]:
    return {tree[0]} | _names(tree[2]) | _names(tree[3]) if isinstance(tree, tuple) else set()


def filter_urls(pages: DataFrame, rules=RULES, most: int = SAMPLE) -> DataFrame:
    """Judges every URL; the URLs that rules decide are the labelled ones that the trees learn from."""
    url = F.col("url")
    labelled = pages.select("url", rule_of(host_of(url), path_of(url), rules)[1].alias("verdict"))
    return judged(pages, train(labelled, most), rules)
