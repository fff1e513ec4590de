"""Fields out of a page's plain text, with what the crawl already knows taking precedence.

A text is looked at as lines (an array column) and as one collapsed line. Label rules ("the line after the label") are
array expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .price import area, price, property_type, total_price, unit_price
from .quality import flags
from .text import blank_to_null, clean_text, first_nonblank

# Labels and patterns of the page's fields, tried in this order.
PRICE_LABELS = ("khoảng giá", "mức giá")
PRICE_LINE = r"thỏa thuận|thoả thuận|\d+(?:[.,]\d+)?\s*(?:tỷ|ty|triệu|trieu)"
PRICE_PATTERNS = (
    r"(?:Khoảng giá|Mức giá)\s+(Thỏa thuận|Thoả thuận)",
    r"(?:Khoảng giá|Mức giá)\s+(\d+(?:[.,]\d+)?\s*(?:tỷ|ty|triệu|trieu))",
    r"(?:giá chỉ|giá bán|giá)\s+(\d+(?:[.,]\d+)?\s*(?:tỷ|ty|triệu|trieu))",
    r"(\d+(?:[.,]\d+)?\s*(?:tỷ|ty))",
)
AREA_LABELS = ("diện tích", "dien tich")
AREA_VALUE = r"(\d+(?:[.,]\d+)?\s*m(?:²|2)?)"
AREA_PATTERNS = (r"Diện tích\s+" + AREA_VALUE, r"Dien tich\s+" + AREA_VALUE, r"\bDT\s*" + AREA_VALUE)
PLACE_PATTERNS = (r"Địa chỉ\s*[:\-]?\s*([^\n\r]+)", r"Khu vực\s*[:\-]?\s*([^\n\r]+)", r"Vị trí\s*[:\-]?\s*([^\n\r]+)")
POSTED_PATTERNS = (r"Ngày đăng\s*[:\-]?\s*([^\n\r]+)", r"Đăng ngày\s*[:\-]?\s*([^\n\r]+)")
BEDROOM_PATTERNS = (r"(\d+)\s*phòng ngủ", r"Phòng ngủ\s*[:\-]?\s*(\d+)")
BATHROOM_PATTERNS = (r"(\d+)\s*phòng tắm", r"(\d+)\s*toilet", r"Phòng tắm\s*[:\-]?\s*(\d+)", r"Toilet\s*[:\-]?\s*(\d+)")
GIVEN = {
    "title": ("title", "listing_title", "title_raw"),
    "price": ("price", "price_raw", "gia", "muc_gia"),
    "area": ("area", "area_raw", "dien_tich"),
    "place": ("address", "location", "location_raw", "detail_location_raw"),
    "posted": ("posted_date", "posted_date_raw", "ngay_dang"),
}
NO_TITLE = ("mức giá", "diện tích", "địa chỉ")
CAPITAL = ("ha-noi", "hà nội", "ha noi")

_F = "(?ium)"


def first_pattern(text: Column, patterns: tuple[str, ...]) -> Column:
    """Group 1 of the first pattern of the list that is found, cleaned."""
    return F.coalesce(*(clean_text(F.regexp_extract(text, _F + p, 1)) for p in patterns))


def lines_of(text: Column) -> Column:
    """Non-blank lines, trimmed."""
    return F.filter(F.transform(F.split(text, r"\R"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")


def by_label(lines: Column, labels: tuple[str, ...], reach: int, pattern: str, on_line: str, group: int = 0) -> Column:
    """The first find by lines in their order: where a line is a label, what the pattern finds first in the `reach` lines
    after it; where a line starts with a label, what on_line finds after it."""
    named = "|".join(labels)

    def find(line: Column, i: Column) -> Column:
        after = F.try_element_at(F.filter(F.slice(lines, i + 2, reach), lambda x: x.rlike(_F + pattern)), F.lit(1))
        after = after if group == 0 else F.regexp_extract(after, _F + pattern, group)
        here = F.regexp_extract(line, f"(?iu)^(?:{named}) \\s*{on_line}", 1)
        return F.when(F.lower(line).isin(*labels), after).otherwise(blank_to_null(here))

    hits = F.filter(F.transform(lines, find), lambda x: x.isNotNull())
    return clean_text(F.try_element_at(hits, F.lit(1)))


def given(df: DataFrame, *names: str) -> Column:
    """The first of the named columns of df that isn't blank."""
    have = [clean_text(F.col(n).cast("string")) for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(None).cast("string"))


def listing_fields(df: DataFrame) -> dict[str, Column]:
    """Raw and parsed fields of rows with raw_text and what the crawl knows (any of the usual columns)."""
    raw = F.coalesce(F.col("raw_text"), F.lit(""))
    lines, flat = lines_of(raw), F.coalesce(clean_text(raw), F.lit(""))
    fit = F.filter(F.slice(lines, 1, 20), lambda x: (F.length(x) >= 15) & ~F.exists(F.array(*map(F.lit, NO_TITLE)), lambda p: F.startswith(F.lower(x), p)))
    title = F.coalesce(given(df, *GIVEN["title"]), clean_text(F.try_element_at(fit, F.lit(1))))
    price_raw = F.coalesce(given(df, *GIVEN["price"]), by_label(lines, PRICE_LABELS, 4, PRICE_LINE, "(.+)"), first_pattern(flat, PRICE_PATTERNS))
    area_raw = F.coalesce(given(df, *GIVEN["area"]), by_label(lines, AREA_LABELS, 3, AREA_VALUE, AREA_VALUE, 1), first_pattern(flat, AREA_PATTERNS))
    city, district = given(df, "crawl_city_label", "crawl_city"), given(df, "crawl_district_label", "crawl_district")
    told, found = given(df, *GIVEN["place"]), first_pattern(raw, PLACE_PATTERNS)
    context = blank_to_null(F.concat_ws(", ", district, city))
    capital = lambda x: F.exists(F.array(*map(F.lit, CAPITAL)), lambda c: F.contains(F.lower(x), c))
    place = F.coalesce(told, found, context)
    out = {
        "title_raw": title,
        "description_raw": clean_text(F.substring(raw, 1, 3000)),
        "price_raw": price_raw,
        "area_raw": area_raw,
        "location_raw": place,
        "location_parse_method": F.when(told.isNotNull(), "metadata_field").when(found.isNotNull(), "detail_text_field").when(context.isNotNull(), "crawl_context").otherwise("unknown"),
        "location_confidence": F.when(told.isNotNull() | found.isNotNull(), "high").when(context.isNotNull(), "medium").otherwise("unknown"),
        "city_norm": F.when(capital(city), "Hà Nội").when(city.isNotNull(), city).when(capital(place), "Hà Nội"),
        "district_norm": district,
        "posted_date_raw": F.coalesce(given(df, *GIVEN["posted"]), first_pattern(raw, POSTED_PATTERNS)),
        "bedroom_count": first_pattern(raw, BEDROOM_PATTERNS).try_cast("int"),
        "bathroom_count": first_pattern(raw, BATHROOM_PATTERNS).try_cast("int"),
    }
    return out


def parsed(df: DataFrame) -> DataFrame:
    """df with all fields, prices, areas and property type."""
    kind = property_type(given(df, "crawl_category", "property_type_group"), F.col("title_raw"))
    out = df.withColumns(listing_fields(df)).withColumn("__p", price(F.col("price_raw"))).withColumn("area_m2", area(F.col("area_raw")))
    p, m2 = F.col("__p"), F.col("area_m2")
    out = out.withColumns({"price_value": p["value"], "price_unit": p["unit"], "price_vnd": total_price(p["vnd"], m2, p["unit"]), "unit_price_vnd_m2": unit_price(p["vnd"], m2, p["unit"])})
    if "property_type_group" not in df.columns:
        out = out.withColumn("property_type_group", kind)
    return out.drop("__p")


def with_quality(df: DataFrame) -> DataFrame:
    """df with quality flags and parse status."""
    c = lambda n, t="string": F.col(n) if n in df.columns else F.lit(None).cast(t)
    return df.withColumns(flags(c("price_vnd"), c("price_unit"), c("area_m2"), c("location_raw"), c("district_norm"), c("city_norm"), c("is_price_negotiable", "boolean"), c("parse_error_message")))


__all__ = ["by_label", "first_nonblank", "first_pattern", "lines_of", "listing_fields", "parsed", "with_quality"]
