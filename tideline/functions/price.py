"""Prices, areas and property types from raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, first_number

# Unit words in the order in which they are looked for.
NEGOTIABLE = ("thỏa thuận", "thoả thuận")
BILLION = ("tỷ", "ty")
MILLION = ("triệu", "trieu")
PER_AREA = ("/m", "m²", "m2")
PLAIN = ("đ", "vnd")
PROPERTY_TYPES = (
    ("apartment", ("can-ho", "chung cư", "chung-cu")),
    ("house", ("nha-rieng", "nhà riêng")),
    ("land", ("ban-dat", "bán đất")),
    ("villa_townhouse", ("biet-thu", "biệt thự", "lien-ke", "liền kề")),
    ("street_house", ("mat-pho", "mặt phố")),
)


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    out = text.contains(words[0])
    for w in words[1:]:
        out = out | text.contains(w)
    return out


def price(raw: Column) -> Column:
    """struct(value double, unit string, vnd bigint) of a raw price; all null if there is nothing to read."""
    text = F.lower(clean_text(raw))
    number = first_number(text)
    unit = F.when(has_any(text, NEGOTIABLE), "negotiable").when(
        number.isNotNull(),
        F.when(has_any(text, BILLION), "ty").when(has_any(text, MILLION), F.when(has_any(text, PER_AREA), "million_per_m2").otherwise("million")).when(has_any(text, PLAIN), "vnd"),
    )
    times = F.when(unit == "ty", 1e9).when(unit.isin("million", "million_per_m2"), 1e6).when(unit == "vnd", 1.0)
    value = F.when(unit.isNull() | (unit != "negotiable"), number)
    return F.struct(value.alias("value"), unit.alias("unit"), (value * times).try_cast("bigint").alias("vnd"))


def area(raw: Column) -> Column:
    return first_number(F.lower(clean_text(raw)))


def unit_price(vnd: Column, m2: Column, unit: Column) -> Column:
    """Price of a square metre."""
    return F.when(unit.eqNullSafe("million_per_m2"), vnd.cast("double")).when(m2 > 0, vnd / m2)


def total_price(vnd: Column, m2: Column, unit: Column) -> Column:
    """Price of the whole; null where a price by area has no area."""
    whole = F.when(m2 > 0, (vnd.cast("double") * m2).try_cast("bigint"))
    return F.when(unit.eqNullSafe("million_per_m2"), whole).otherwise(vnd.cast("bigint"))


def property_type(category: Column, title: Column) -> Column:
    text = F.lower(F.concat(F.coalesce(category, F.lit("")), F.lit(" "), F.coalesce(title, F.lit(""))))
    out = None
    for name, words in PROPERTY_TYPES:
        out = F.when(has_any(text, words), name) if out is None else out.when(has_any(text, words), name)
    return out.otherwise("unknown")
