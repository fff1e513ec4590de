"""Features of a listing's text as expressions over one shared search text: no Python on the executors.

Where several patterns compete, the earliest match wins, then the first pattern: the least (place, pattern, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import feature_values as v
from .text import SPACE, blank_to_null, first_nonblank, joined, search_form

_I = "(?i)"
_RAW = "(?iu)"


def _has(text: Column, pattern: str) -> Column:
    return text.rlike(_I + pattern)


def _earliest(text: Column, patterns: tuple[tuple[str, Column], ...]) -> Column:
    """The value of the pattern that matches first; null if none does."""
    found = [F.struct(F.nullif(F.regexp_instr(text, F.lit(_I + p)), F.lit(0)).alias("at"), F.lit(i).alias("i"), value.alias("value")) for i, (p, value) in enumerate(patterns)]
    return F.array_min(F.filter(F.array(*found), lambda x: x["at"].isNotNull()))["value"]


def _number(text: Column, patterns: tuple[str, ...], low: float, high: float, kind: str = "int") -> Column:
    value = _earliest(text, tuple((p, F.regexp_replace(F.regexp_extract(text, _I + p, 1), ",", ".")) for p in patterns)).try_cast(kind)
    return F.when(value.between(low, high), value)


def shortened(x: Column, most: int) -> Column:
    """x collapsed and cut to `most` characters, at a space if there is one."""
    x = F.trim(F.regexp_replace(x, SPACE, " "))
    cut = F.substring(x, 1, most)
    at_space = F.trim(F.regexp_replace(cut, "(?s) [^ ]*$", ""))
    return F.when(F.length(x) <= most, x).when(at_space != "", at_space).otherwise(F.trim(cut))


def negotiable(text: Column) -> Column:
    """Whether a keyword stands without a negation within the three words before it."""
    words = lambda s: F.filter(F.split(s, SPACE), lambda w: w != "")
    # The text before each keyword in turn: pieces of the text split at keywords, put together up to it.
    pieces = F.split(text, _I + v.NEGOTIABLE)
    keys = F.regexp_extract_all(text, F.lit(_I + f"({v.NEGOTIABLE})"), F.lit(1))
    count = F.size(keys)

    def before(i: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), i), lambda j: F.concat(F.element_at(pieces, (j + 1).cast("int")), F.when(j < i, F.element_at(keys, (j + 1).cast("int"))).otherwise("")))
        last = words(F.array_join(parts, ""))
        return F.concat(F.array_join(F.slice(last, F.greatest(F.size(last) - 2, F.lit(1)), 3), " "), F.lit(" "))

    return F.when(count > 0, F.exists(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: ~before(i).rlike(_I + v.NEGATION))).otherwise(False)


def feature_columns(search: Column, raw: Column, kind: Column, known: dict[str, Column] | None = None) -> dict[str, Column]:
    """The 22 features by name; all null where raw is blank. known: values that a listing has already (bathroom_count,
    bedroom_count, project_raw, seller_type), which the text's yield to or complete."""
    known = known or {}
    t = search
    legal = F.regexp_extract(t, _I + v.LEGAL, 1)
    floors = _earliest(
        t,
        (
            (v.GROUND_AND_FLOORS, (F.regexp_extract(t, _I + v.GROUND_AND_FLOORS, 1).try_cast("int") + 1)),
            (v.FLOORS, F.concat(F.regexp_extract(t, _I + v.FLOORS, 1), F.regexp_extract(t, _I + v.FLOORS, 2)).try_cast("int")),
        ),
    )
    furniture = F.coalesce(*(F.when(_has(t, p), level) for level, p in v.FURNITURE.items()))
    direction = blank_to_null(F.regexp_replace(F.regexp_extract(t, _I + v.DIRECTION, 1), " ", "_"))
    car = _earliest(t, tuple((p, F.lit(name)) for name, p in v.CAR_ACCESS.items()))
    seller = F.when(_has(t, v.OWNER), "owner").when(_has(t, v.BROKER), "broker")
    building = F.split(F.regexp_extract(raw, _RAW + v.BUILDING, 1), r",|\n|\r|\.\s", 2)[0]
    given = lambda name: F.nullif(known[name], F.lit(0)) if name in known else F.lit(None).cast("int")
    named = lambda name: blank_to_null(known[name]) if name in known else F.lit(None).cast("string")
    out = {
        "has_legal_info": legal != "",
        "legal_status_raw": blank_to_null(F.substring(legal, 1, 100)),
        "has_red_pink_book": _has(t, v.RED_PINK_BOOK) & (legal != ""),
        "floor_count": F.when(floors.between(1, 50), floors),
        "seller_type": F.coalesce(seller, named("seller_type")),
        "furniture_level": furniture,
        "frontage_width": _number(t, v.FRONTAGE, 1, 100, "double"),
        "bathroom_count": F.coalesce(given("bathroom_count"), _number(t, v.BATHROOMS, 1, 20)),
        "bedroom_count": F.coalesce(given("bedroom_count"), _number(t, v.BEDROOMS, 1, 30)),
        "project_name": F.coalesce(named("project_raw"), blank_to_null(shortened(F.regexp_extract(raw, _RAW + v.PROJECT, 1), 100))),
        "is_business_suitable": _has(t, v.BUSINESS),
        "has_urban_area_flag": _has(t, v.URBAN),
        "has_security_flag": _has(t, v.SECURITY),
        "has_educated_community_flag": _has(t, v.EDUCATED),
        "has_high_intellect_flag": _has(t, v.EDUCATED),
        "has_residential_area_flag": _has(t, v.RESIDENTIAL),
        "has_subdivision_flag": _has(t, v.SUBDIVISION),
        "direction": F.coalesce(*(F.when(direction == k, full) for k, full in v.DIRECTION_SHORT.items()), direction),
        "is_price_negotiable": negotiable(t),
        "has_car_access": car.isNotNull(),
        "car_access_type": car,
        "building_name": blank_to_null(shortened(building, 50)),
    }
    skipped = {name: [k for k, names in v.SKIPPED.items() if name in names] for name in out}
    some = F.coalesce(F.trim(raw) != "", F.lit(False))
    return {name: F.when(some & ~F.coalesce(kind, F.lit("")).isin(skipped[name]) if skipped[name] else some, value) for name, value in out.items()}


def with_features(df: DataFrame, fields: tuple[str, ...] = ("title_raw", "description_raw", "location_raw", "property_type_raw", "raw_text")) -> DataFrame:
    """df with the features of its text fields (those that it has), which win over columns of the same name."""
    raw = joined(*(F.col(f).cast("string") for f in fields if f in df.columns)) if any(f in df.columns for f in fields) else F.lit("")
    df = df.withColumn("__raw", raw).withColumn("__search", search_form(F.col("__raw")))
    known = {c: F.col(c) for c in ("bathroom_count", "bedroom_count", "project_raw", "seller_type") if c in df.columns}
    kind = F.col("property_type_group") if "property_type_group" in df.columns else F.lit(None).cast("string")
    made = feature_columns(F.col("__search"), F.col("__raw"), kind, known)
    return df.withColumns(made).drop("__raw", "__search")


__all__ = ["feature_columns", "first_nonblank", "negotiable", "shortened", "with_features"]
