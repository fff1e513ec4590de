"""Judgements on crawled pages: blocks, evidence of place and category, rollups of a crawl's log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, search_form
from .marts import rate

# Signs of a block by reason, and words of categories.
BLOCK_SIGNS = (
    ("cloudflare_turnstile", ("challenges.cloudflare.com/turnstile",)),
    ("cloudflare_challenge", ("<title>just a moment", "cf-browser-verification", "/cdn-cgi/challenge-platform", "__cf_chl", "cf-chl-", "attention required! | cloudflare")),
    ("captcha", ("g-recaptcha", "h-captcha")),
)
CATEGORY_WORDS = {
    "mua-ban-can-ho-chung-cu": ("can ho", "chung cu"),
    "mua-ban-nha-dat": ("nha", "nha dat", "dat"),
    "ban-can-ho-chung-cu": ("can ho", "chung cu"),
    "ban-nha-rieng": ("nha rieng",),
    "ban-dat": ("dat",),
    "ban-nha-biet-thu-lien-ke": ("biet thu", "lien ke"),
}


def block_reason(status: Column, html: Column, found: Column | None = None) -> Column:
    """Why a page is a block, or null: 403 and 429 always; signs in it unless it yielded listings."""
    low = F.lower(F.coalesce(html, F.lit("")))
    sign = F.coalesce(*(F.when(low.contains(s), reason) for reason, signs in BLOCK_SIGNS for s in signs))
    usable = F.coalesce(found > 0, F.lit(False)) if found is not None else F.lit(False)
    return F.when(status == 403, "http_403").when(status == 429, "http_429").when(~usable, sign)


def retryable(status: Column) -> Column:
    """Whether a request is worth repeating."""
    return F.coalesce(status.isin(0, 403, 408, 425, 429) | status.between(500, 599), F.lit(True))


def valid_seed(seed: Column, final: Column, path: Column) -> Column:
    """Whether the page that a seed URL led to is still about its place."""
    end = F.regexp_replace(final, "/+$", "")
    api = "gateway.chotot.com/v1/public/ad-listing"
    plain = end.contains(path) & (end != "https://batdongsan.com.vn") & ~end.endswith("/nha-dat-ban")
    return F.coalesce((F.coalesce(final, F.lit("")) != "") & ((seed.contains(api) & end.contains(api)) | plain), F.lit(False))


def _norm(x: Column) -> Column:
    return search_form(x, symbols=False)


def place_matches(text: Column, label: Column, slug: Column) -> Column:
    t = _norm(text)
    by_label, by_slug = _norm(label), F.lower(F.replace(F.coalesce(slug, F.lit("")), F.lit("-"), F.lit(" ")))
    return (F.coalesce(text, F.lit("")) != "") & (((by_label != "") & t.contains(by_label)) | ((by_slug != "") & t.contains(by_slug)))


def other_place(text: Column, label: Column, known: tuple[str, ...]) -> Column:
    """The first known place, other than the expected, that a text names."""
    t, own = _norm(text), _norm(label)
    tests = [F.when((_norm(F.lit(k)) != own) & (_norm(F.lit(k)) != "") & t.contains(_norm(F.lit(k))), k) for k in known]
    return F.when(F.coalesce(text, F.lit("")) != "", F.coalesce(*tests, F.lit(None).cast("string")))


def category_matches(text: Column, category: Column) -> Column:
    t = _norm(text)
    out = F.lit(False)
    for name, words in CATEGORY_WORDS.items():
        found = F.lit(False)
        for w in words:
            found = found | t.contains(w)
        out = F.when(category == name, found).otherwise(out)
    return out


def place_of_text(text: Column, label: Column, slug: Column, seed_ok: Column, known: tuple[str, ...] = ()) -> Column:
    """struct(status, confidence, method) by a detail text alone."""
    row = lambda s, c, m: F.struct(F.lit(s).alias("status"), F.lit(c).alias("confidence"), (m if isinstance(m, Column) else F.lit(m)).alias("method"))
    other = other_place(text, label, known)
    return (
        F.when(~F.coalesce(seed_ok, F.lit(False)), row("unknown", "low", "invalid_seed_url"))
        .when(place_matches(text, label, slug), row("matched", "high", "detail_text_contains_location"))
        .when(other.isNotNull(), row("mismatch", "low", F.concat(F.lit("detail_text_contains_other_location:"), other)))
        .otherwise(row("assumed_from_seed", "medium", "seed_url_context"))
    )


def place_evidence(df: DataFrame, label: Column, slug: Column, path: Column, known: tuple[str, ...] = ()) -> Column:
    """struct of six fields: the first text of address, card and breadcrumb that is there decides (match, another known
    place, or plain mismatch); without any, the URL's path, then title and description, then a valid seed."""
    c = lambda *names: F.coalesce(*(blank_to_null(F.col(n)) for n in names if n in df.columns), F.lit(None).cast("string"))

    def row(text, source, detail, status, confidence, method) -> Column:
        as_column = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
        names = ("evidence_text", "evidence_source", "detail_location_raw", "match_status", "match_confidence", "match_method")
        return F.struct(*(as_column(x).alias(n) for x, n in zip((text, source, detail, status, confidence, method), names, strict=True)))

    out = None
    rungs = (("detail_address_block", c("detail_address_raw")), ("listing_card_location", c("listing_card_location_raw")), ("breadcrumb", c("breadcrumb_location_raw", "breadcrumb_raw")))
    for name, text in rungs:
        other = other_place(text, label, known)
        verdict = (
            F.when(place_matches(text, label, slug), row(text, name, text, "matched", "high", name))
            .when(other.isNotNull(), row(text, name, text, "mismatch", "low", F.concat(F.lit(f"{name}_contains_other_location:"), other)))
            .otherwise(row(text, name, text if name == "detail_address_block" else None, "mismatch", "low", f"{name}_does_not_match_target"))
        )
        out = F.when(text.isNotNull(), verdict) if out is None else out.when(text.isNotNull(), verdict)
    words = F.concat_ws(" ", c("title"), c("description"))
    seed = F.coalesce(F.col("is_seed_url_valid"), F.lit(False)) if "is_seed_url_valid" in df.columns else F.lit(False)
    url = F.coalesce(c("final_detail_url", "listing_url"), F.lit(""))
    return (
        out.when((F.coalesce(path, F.lit("")) != "") & url.contains(path), row(None, "detail_url", None, "matched", "high", "detail_url_contains_location_path"))
        .when(place_matches(words, label, slug), row(None, "title_or_description", None, "matched", "medium", "title_or_description_contains_location"))
        .when(seed, row(None, "seed_url", None, "assumed_from_seed", "medium", "seed_url_context"))
        .otherwise(row(None, "none", None, "unknown", "low", "no_location_evidence"))
    )


def crawl_summary(log: DataFrame, *by: str) -> DataFrame:
    """Rates and counts of a crawl's log (status, block_reason, listing_url, html_bytes, audit_passed)."""
    out = log.groupBy(*by).agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status").between(200, 299) & F.col("block_reason").isNull()).alias("successes"),
        F.count_if(F.col("block_reason").isNotNull()).alias("blocked"),
        (F.count("listing_url") - F.count_distinct("listing_url")).alias("duplicate_urls"),
        F.avg("html_bytes").alias("avg_html_bytes"),
        F.count_if("audit_passed").alias("audits_passed"),
    )
    n = F.col("requests")
    return out.withColumns({"success_rate": rate(F.col("successes"), n), "block_rate": rate(F.col("blocked"), n), "audit_pass_rate": rate(F.col("audits_passed"), n)})


def with_card_fields(details: DataFrame, cards: DataFrame) -> DataFrame:
    """details with the card fields of the same listing_url that it lacks; of several cards the first by card_position
    (as `cards` of the page source gives it) and, of equal places, by text."""
    fields = [c for c in cards.columns if c.startswith("listing_card_") and c not in details.columns]
    place = [F.col("card_position")] if "card_position" in cards.columns else []
    one = cards.groupBy("listing_url").agg(F.min_by(F.struct(*fields), F.struct(*place, *fields)).alias("__card"))
    return details.join(one, "listing_url", "left").select(*details.columns, *(F.col(f"__card.{c}").alias(c) for c in fields))
