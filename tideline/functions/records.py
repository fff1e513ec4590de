"""Whole records out of crawled listings: of pages by their text, of the API by its fields, and the routing between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .extract import given, parsed
from .price import area, price, total_price, unit_price
from .text import clean_text

# The fields of a record in order; those marked by `*` are the API record's alone.
FIELDS = (
    "source", "source_code*", "crawl_date", "crawl_id", "listing_id", "listing_url", "dedup_key*", "dedup_method*", "title_raw", "description_raw", "price_raw", "area_raw", "location_raw",
    "price_value", "price_unit", "price_vnd", "area_m2", "unit_price_vnd_m2", "property_type_raw", "property_type_group", "listing_business_type", "city_raw", "district_raw", "ward_raw", "street_raw",
    "project_raw", "city_norm", "district_norm", "ward_norm", "location_confidence", "location_parse_method", "bedroom_count", "bathroom_count", "floor_count", "seller_type", "seller_years_on_platform",
    "seller_active_listing_count", "has_broker_certificate", "phone_masked", "image_count", "has_image", "posted_date_raw", "expired_date_raw", "posted_date", "expired_date", "parse_status",
    "parse_error_message", "raw_html_path", "raw_text_path", "metadata_path", "parser_version", "processed_at",
)
VERSION = "phase2_v1"
NUMBERS = {"price_vnd": "bigint", "price_value": "double", "area_m2": "double", "unit_price_vnd_m2": "double", "bedroom_count": "int", "bathroom_count": "int", "floor_count": "int", "seller_years_on_platform": "int", "seller_active_listing_count": "int", "image_count": "int"}
FLAGS = ("has_broker_certificate", "has_image")


def _now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _record(df: DataFrame, made: dict[str, Column], api: bool) -> DataFrame:
    """df's rows as records: fields that aren't made are df's own, or null; every field has its type."""
    out = []
    for field in FIELDS:
        name = field.rstrip("*")
        if name != field and not api:
            continue
        value = made.get(name, F.col(name) if name in df.columns else F.lit(None))
        kind = NUMBERS.get(name) or ("boolean" if name in FLAGS else "string")
        value = value.try_cast("double").cast(kind) if kind in ("int", "bigint") and name not in made else value.try_cast(kind)
        out.append(value.alias(name))
    return df.select(*out)


def _common(df: DataFrame, version: str) -> dict[str, Column]:
    nothing = F.lit(None).cast("string")
    own = F.col("crawl_category") if "crawl_category" in df.columns else nothing
    return {"property_type_raw": own, "posted_date": nothing, "expired_date": nothing, "parse_status": F.lit("success"), "parse_error_message": nothing, "parser_version": F.lit(version), "processed_at": _now()}


def page_records(df: DataFrame, version: str = VERSION) -> DataFrame:
    """Records of rows with raw_text and what the crawl knows: 49 fields. Floors, dates and places under a district stay
    null, as later steps find them."""
    rows = parsed(df)
    nothing = F.lit(None).cast("string")
    made = {**_common(df, version), "floor_count": F.lit(None).cast("int"), "ward_raw": nothing, "street_raw": nothing, "project_raw": nothing, "ward_norm": nothing, "city_raw": given(df, "crawl_city_label", "crawl_city"), "district_raw": given(df, "crawl_district_label", "crawl_district")}
    made |= {c: F.col(c) for c in ("bedroom_count", "bathroom_count", "posted_date_raw")}
    return _record(rows, made, False)


def api_records(df: DataFrame, version: str = VERSION, source: str = "nhatot") -> DataFrame:
    """Records of rows with the API's fields (any of them): 52 fields, with a key of their own."""
    text = lambda *names: given(df, *names)
    name = F.coalesce(text("source", "source_code"), F.lit(source))
    price_raw, area_raw = text("listing_card_price_raw"), text("listing_card_area_raw")
    number = lambda c: F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double")
    p = price(price_raw)
    vnd, m2 = F.coalesce(number("price_vnd").cast("bigint"), p["vnd"]), F.coalesce(number("area_m2"), area(area_raw))
    ident, url = text("listing_id"), text("listing_url")
    raw = clean_text(F.substring("raw_text", 1, 3000)) if "raw_text" in df.columns else F.lit(None).cast("string")
    places = {"city": text("city_raw", "crawl_city_label", "crawl_city"), "district": text("district_raw", "crawl_district_label", "crawl_location_label"), "ward": text("ward_raw")}
    made = {
        **_common(df, version),
        "source": name,
        "source_code": F.coalesce(text("source_code"), name),
        "dedup_key": F.when(ident.isNotNull(), F.concat_ws("::", name, ident)).when(url.isNotNull(), F.concat_ws("::", name, url)),
        "dedup_method": F.when(ident.isNotNull(), "listing_id").when(url.isNotNull(), "listing_url"),
        "title_raw": text("title", "listing_card_title"),
        "description_raw": F.coalesce(text("description", "listing_card_description"), raw),
        "price_raw": price_raw,
        "area_raw": area_raw,
        "location_raw": text("detail_address_raw", "listing_card_location_raw", "breadcrumb_location_raw", "crawl_location_label"),
        "price_value": p["value"],
        "price_unit": p["unit"],
        "price_vnd": total_price(vnd, m2, p["unit"]),
        "area_m2": m2,
        "unit_price_vnd_m2": unit_price(vnd, m2, p["unit"]),
        "property_type_group": F.coalesce(text("property_type_group"), F.lit("unknown")),
        **{f"{k}_raw": v for k, v in places.items()},
        **{f"{k}_norm": v for k, v in places.items()},
        "location_confidence": F.coalesce(text("location_match_confidence"), F.lit("medium")),
        "location_parse_method": F.coalesce(text("location_match_method"), F.lit("metadata_field")),
    }
    return _record(df, made, True)


def records(df: DataFrame, version: str = VERSION) -> DataFrame:
    """Records of all rows, each by its source's parser: the API's for its source, the page's for all others; fields that
    only one of them has are null for the other."""
    named = [F.nullif(F.col(c), F.lit("")) for c in ("source_code", "source") if c in df.columns]
    api = F.coalesce(F.lower(F.trim(F.coalesce(*named, F.lit("")))) == "nhatot", F.lit(False))
    parts = [api_records(df.filter(api), version), page_records(df.filter(~api), version)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
