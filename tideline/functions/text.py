"""Text functions as column expressions. White space is Unicode's: (?U) where Java would only see ASCII."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def collapsed(x: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(x, SPACE, " "))


def clean_text(x: Column) -> Column:
    """Collapsed text with bullets as spaces; null if nothing is left."""
    return blank_to_null(collapsed(F.regexp_replace(x, "[·•]", " ")))


def _folding() -> tuple[str, str]:
    """Letters of the Latin blocks whose decomposition starts with an ASCII letter, and those letters."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        ch = unicodedata.normalize("NFD", chr(code))
        if len(ch) > 1 and ch[0].isascii():
            pairs[chr(code)] = ch[0]
    pairs["đ"], pairs["Đ"] = "d", "D"
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = _folding()


def unaccented(x: Column) -> Column:
    """Base letters in the place of accented ones; separate combining marks go."""
    return F.regexp_replace(F.translate(x, _FROM, _TO), r"\p{Mn}", "")


def search_form(x: Column, symbols: bool = True) -> Column:
    """Lower-case, unaccented, collapsed; with symbols, square and cube signs in plain letters; null is ''."""
    out = unaccented(F.lower(F.coalesce(x, F.lit(""))))
    if symbols:
        out = F.regexp_replace(F.regexp_replace(F.translate(out, "²³", "23"), "㎡", "m2"), "㎥", "m3")
    return collapsed(out)


def joined(*parts: Column) -> Column:
    """Non-blank parts with a space between."""
    return F.concat_ws(" ", *(F.when(F.trim(p) != "", p) for p in parts))


def plain(x: Column, default: str = "") -> Column:
    """Lower-case and collapsed, null as the default."""
    return F.lower(collapsed(F.coalesce(x.cast("string"), F.lit(default))))


def slug(x: Column, gap: str = "_", empty: str = "unknown") -> Column:
    """ASCII letters and digits with gaps between; accented letters are gaps."""
    return F.coalesce(blank_to_null(F.regexp_replace(F.regexp_replace(plain(x), "[^a-z0-9]+", gap), f"^{gap}+|{gap}+$", "")), F.lit(empty))


def accent_slug(x: Column) -> Column:
    """As slug, by hyphens, with accents taken off first."""
    return F.lower(F.regexp_replace(F.regexp_replace(unaccented(F.coalesce(x, F.lit(""))), "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))


def hash_key(*parts: Column) -> Column:
    """A surrogate key: 16 hexadecimal digits of SHA-256 over lower-case trimmed parts; null counts as NONE."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(F.lower(F.trim(p.cast("string"))), F.lit("NONE")) for p in parts)), 256), 1, 16)


def first_number(x: Column) -> Column:
    """The first number of a text, with either decimal mark."""
    return F.regexp_replace(F.regexp_extract(x, r"(\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")


def first_nonblank(*parts: Column) -> Column:
    return F.coalesce(*(F.when(F.trim(p) != "", p) for p in parts))


def url_listing_id(url: Column) -> Column:
    """The number after `pr` in a URL, or else the URL's MD5."""
    return F.coalesce(blank_to_null(F.regexp_extract(url, r"pr(\d+)", 1)), F.md5(url))


def in_brackets_old(x: Column) -> Column:
    """Text in brackets that names a former unit."""
    return blank_to_null(F.trim(F.regexp_extract(x, r"(?iu)\(([^)]*\bc[uũ]\b[^)]*)\)", 1)))


def page_url(url: Column, page: Column) -> Column:
    """A list URL for a page: the last `page=` is replaced, else the path gets /pN; page 1 is the URL itself."""
    last = F.regexp_replace(url, "page=[0-9]+(?!.*page=)", F.concat(F.lit("page="), page.cast("string")))
    path = F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/p"), page.cast("string"))
    return F.when(page <= 1, url).when(url.rlike("page=[0-9]+"), last).otherwise(path)


def seed_url(site: Column, category: Column, place: Column, page: Column | None = None) -> Column:
    """The list URL of a category in a place (`site/category-place`; without a place `site/category`), for a page."""
    base = F.concat(F.regexp_replace(site, "/+$", ""), F.lit("/"), category, F.when(F.coalesce(place, F.lit("")) != "", F.concat(F.lit("-"), place)).otherwise(""))
    return base if page is None else page_url(base, page)


def file_slug(x: Column) -> Column:
    """A name for a file: lower-case ASCII letters and digits with underscores between."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def percent(x: Column) -> Column:
    """A share for display."""
    return F.when(x.isNull(), "N/A").otherwise(F.format_string("%.2f%%", x * 100))


def date_key(x: Column) -> Column:
    """yyyymmdd as an integer; null for what is no date."""
    return F.date_format(F.try_to_date(x.cast("string")), "yyyyMMdd").cast("int")
