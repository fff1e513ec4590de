"""Listings out of API payloads, page state and HTML, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import accent_slug, blank_to_null, clean_text, in_brackets_old

#: An ad as the API writes it; fields that it lacks are null.
AD = (
    "struct<ad_id: bigint, id: bigint, list_id: bigint, category: int, category_slug: string, location_slug: string, district_slug: string, subject: string, title: string, price_string: string, price_raw: string, price: bigint, "
    "size: double, size_unit_string: string, area_raw: string, region_name: string, city_name: string, area_name: string, district_name: string, ward_name: string, street_name: string, body: string, description: string, "
    "property_type_group: string, rooms: int, toilets: int, listing_url: string, url: string, web_url: string, detail_address: string, params: array<struct<id: string, value: string>>>"
)
#: Where a page's state holds its ads; the site, and what stands for an unknown category or place.
STATE_PATHS = ("$.props.initialState.adlisting.data.ads", "$.props.pageProps.initialState.adlisting.data.ads")
SITE, ANY_CATEGORY, ANY_PLACE = "https://www.nhatot.com", "mua-ban-nha-dat", "viet-nam"


def script_state(html: Column) -> Column:
    """The JSON of a page's state script; null without one."""
    return blank_to_null(F.regexp_extract(html, r"""(?is)<script[^>]*\bid=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1))


def api_ads(payload: Column) -> Column:
    """Array of ads of an API list payload; null if it is no JSON."""
    return F.from_json(F.get_json_object(payload, "$.ads"), f"array<{AD}>")


def state_ads(html: Column) -> Column:
    """Array of ads of a page's state, at the first place that has a list."""
    state = script_state(html)
    return F.from_json(F.coalesce(*(F.get_json_object(state, p) for p in STATE_PATHS)), f"array<{AD}>")


def parameter(ad: Column, name: str) -> Column:
    """The value of an ad's parameter by id."""
    return clean_text(F.try_element_at(F.filter(ad["params"], lambda p: p["id"] == name), F.lit(1))["value"])


def ad_columns(ad: Column, source: str = "nhatot") -> dict[str, Column]:
    """The canonical list record of an ad."""
    own, public = F.coalesce(ad["ad_id"], ad["id"], ad["list_id"]), F.coalesce(ad["list_id"], ad["ad_id"], ad["id"])
    district, city = F.coalesce(ad["area_name"], ad["district_name"]), F.coalesce(ad["region_name"], ad["city_name"])
    place = F.coalesce(clean_text(ad["location_slug"]), blank_to_null(F.concat_ws("-", blank_to_null(accent_slug(district)), blank_to_null(accent_slug(city)))), F.lit(ANY_PLACE))
    category = F.coalesce(clean_text(ad["category_slug"]), F.lit(ANY_CATEGORY))
    explicit = F.coalesce(clean_text(ad["listing_url"]), clean_text(ad["url"]), clean_text(ad["web_url"]))
    absolute = F.when(explicit.rlike("^[A-Za-z]+://"), explicit).otherwise(F.concat(F.lit(SITE), F.when(explicit.startswith("/"), "").otherwise("/"), explicit))
    made = F.concat(F.lit(f"{SITE}/"), category, F.lit("-"), place, F.lit("/"), public.cast("string"), F.lit(".htm"))
    size = F.regexp_replace(ad["size"].cast("string"), r"\.0$", "")
    return {
        "source": F.lit(source),
        "source_code": F.lit(source),
        "listing_id": own.cast("string"),
        "listing_url": F.coalesce(absolute, made),
        "listing_card_title": clean_text(F.coalesce(ad["subject"], ad["title"])),
        "listing_card_price_raw": clean_text(F.coalesce(ad["price_string"], ad["price_raw"])),
        "listing_card_area_raw": F.coalesce(clean_text(ad["area_raw"]), clean_text(ad["size_unit_string"]), F.concat(size, F.lit(" m2"))),
        "listing_card_location_raw": clean_text(F.concat_ws(", ", *(clean_text(x) for x in (ad["ward_name"], district, city)))),
        "listing_card_description": clean_text(F.coalesce(ad["body"], ad["description"])),
        "property_type_group": clean_text(ad["property_type_group"]),
        "city_raw": clean_text(city),
        "district_raw": clean_text(district),
        "ward_raw": clean_text(ad["ward_name"]),
        "bedroom_count": ad["rooms"],
        "bathroom_count": ad["toilets"],
        "price_vnd": ad["price"],
        "area_m2": ad["size"],
    }


def ads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each ad with an identity of each payload: API JSON, or a page with a state script."""
    x = F.col(payload)
    every = F.when(F.ltrim(x).startswith("{"), api_ads(x)).otherwise(state_ads(x))
    rest = [c for c in df.columns if c != payload]
    out = df.select(*rest, F.explode(every).alias("__ad"))
    return out.select(*rest, *(v.alias(k) for k, v in ad_columns(F.col("__ad")).items())).filter("listing_id is not null")


def entities(x: Column) -> Column:
    """The usual character references as characters."""
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(ch))
    return x


def html_text(html: Column) -> Column:
    """Text of a page, a line for each run between tags, without scripts, styles and comments."""
    x = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "")
    x = F.regexp_replace(x, r"(?s)<[a-zA-Z/][^>]*>", "\n")
    lines = F.filter(F.transform(F.split(entities(x), r"\R"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", "")), lambda s: s != "")
    return F.array_join(lines, "\n")


def by_class(html: Column, *classes: str) -> Column:
    """Text of the first element with one of the classes, up to its own end tag (elements of the same name in it end it)."""
    names = "|".join(classes)
    inner = F.regexp_extract(html, rf"""(?is)<(\w+)[^>]*\bclass=["'][^"']*(?<![\w-])(?:{names})(?![\w-])[^"']*["'][^>]*>(.*?)</\1\s*>""", 2)
    return clean_text(entities(F.regexp_replace(inner, "(?s)<[^>]*>", " ")))


def detail_fields(html: Column) -> dict[str, Column]:
    crumb = by_class(html, "re__breadcrumb", "js__breadcrumb")
    return {
        "detail_title": by_class(html, "re__pr-title", "js__pr-title"),
        "detail_address_raw": by_class(html, "re__address-line-1"),
        "breadcrumb_raw": crumb,
        "breadcrumb_location_raw": crumb,
        "detail_description": by_class(html, "re__section-body"),
    }


def cards(df: DataFrame, html: str = "html", site: str = "https://batdongsan.com.vn") -> DataFrame:
    """One row for each listing URL of each list page: the fields of its first card."""
    parts = F.split(F.col(html), r"""(?is)(?=<\w+[^>]*\bclass=["'][^"']*\bjs__card-listing\b)""")
    rest = [c for c in df.columns if c != html]
    # A page's first card of a URL counts, whatever other pages have; the key is made before the cards are.
    keyed = df.select(*rest, F.col(html), F.monotonically_increasing_id().alias("__page"))
    out = keyed.select(*rest, "__page", F.posexplode(parts).alias("__at", "__card")).filter("__at > 0 or __card rlike 'js__card-listing'")
    link = F.regexp_extract("__card", r"""(?is)<a[^>]*\bhref=["']([^"']*pr\d+[^"']*)["']""", 1)
    url = F.when(link.rlike("^https?://"), link).otherwise(F.concat(F.lit(site), F.when(link.startswith("/"), "").otherwise("/"), link))
    out = out.withColumn("listing_url", F.when(link != "", url)).filter(F.col("listing_url").contains(site.split("//")[1]))
    where = by_class(F.col("__card"), "re__card-location")
    out = out.select(
        *rest, "__page", "__at", "listing_url", by_class(F.col("__card"), "js__card-title", "pr-title", "re__card-title").alias("listing_card_title"), by_class(F.col("__card"), "re__card-config-price").alias("listing_card_price_raw"),
        by_class(F.col("__card"), "re__card-config-area").alias("listing_card_area_raw"), where.alias("listing_card_location_raw"), in_brackets_old(where).alias("listing_card_old_district_raw"),
        by_class(F.col("__card"), "js__card-description", "re__card-description").alias("listing_card_description"),
    )
    fields = [c for c in out.columns if c not in ("__page", "__at", "listing_url")]
    first = out.groupBy("__page", "listing_url").agg(F.min_by(F.struct(*fields), "__at").alias("r"), F.min("__at").alias("__at"))
    # card_position rises with pages in their order and cards on them.
    return first.select("listing_url", *(F.col(f"r.{c}").alias(c) for c in fields), F.struct(F.col("__page").alias("page"), F.col("__at").alias("at")).alias("card_position"))
