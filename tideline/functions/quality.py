"""Quality flags, parse status and score of a listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of plausible prices (VND) and areas (square metres); points of the score.
PRICE_BOUNDS = (100_000_000, 1_000_000_000_000)
AREA_BOUNDS = (5, 10_000)


def _is(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _truthy(x: Column) -> Column:
    return _is(x != "")


def flags(vnd: Column, unit: Column, m2: Column, location: Column, district: Column, city: Column, negotiable: Column, error: Column) -> dict[str, Column]:
    """All flags and parse_status, by name. vnd and m2 may be text: what is no number is invalid."""
    price, size = vnd.try_cast("double"), m2.try_cast("double")
    talk = _is(unit == "negotiable") | _is(negotiable)
    no_price = vnd.isNull() & ~talk
    no_area = m2.isNull()
    no_place = ~(_truthy(location) | _truthy(district) | _truthy(city))
    return {
        "is_price_negotiable": talk,
        "is_missing_price": no_price,
        "is_missing_area": no_area,
        "is_missing_location": no_place,
        "is_invalid_price": _is(price <= 0) | (vnd.isNotNull() & price.isNull()),
        "is_invalid_area": _is(size <= 0) | (m2.isNotNull() & size.isNull()),
        "is_outlier_price": _is((price < PRICE_BOUNDS[0]) | (price > PRICE_BOUNDS[1])),
        "is_outlier_area": _is((size < AREA_BOUNDS[0]) | (size > AREA_BOUNDS[1])),
        "parse_status": F.when(_truthy(error), "failed").when(no_price | no_area | no_place, "partial_success").otherwise("success"),
    }


def score() -> Column:
    """Points for what a listing has, over canonical columns; the greatest is 28."""
    c = F.col
    terms = (
        (c("parse_status") == "success", 10),
        (c("price_vnd").isNotNull(), 5),
        (c("price_unit") == "negotiable", 3),
        (c("area_m2").isNotNull(), 5),
        (c("district_norm").isNotNull(), 3),
        (c("location_raw").isNotNull(), 2),
    )
    return sum((F.when(test, points).otherwise(0) for test, points in terms), F.lit(0))
