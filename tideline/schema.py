"""The canonical listing: one typed schema, read once, with missing columns as nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names and types of its columns.
LISTING = {
    "source": "string",
    "crawl_date": "string",
    "crawl_id": "string",
    "listing_id": "string",
    "listing_url": "string",
    "title_raw": "string",
    "description_raw": "string",
    "price_vnd": "bigint",
    "price_unit": "string",
    "area_m2": "double",
    "unit_price_vnd_m2": "double",
    "city_norm": "string",
    "district_norm": "string",
    "ward_norm": "string",
    "location_raw": "string",
    "property_type_group": "string",
    "bedroom_count": "int",
    "bathroom_count": "int",
    "floor_count": "int",
    "frontage_width": "double",
    "project_name": "string",
    "building_name": "string",
    "direction": "string",
    "seller_type": "string",
    "furniture_level": "string",
    "has_legal_info": "boolean",
    "has_car_access": "boolean",
    "is_price_negotiable": "boolean",
    "is_missing_price": "boolean",
    "is_missing_area": "boolean",
    "is_missing_location": "boolean",
    "is_invalid_price": "boolean",
    "is_invalid_area": "boolean",
    "is_outlier_price": "boolean",
    "is_outlier_area": "boolean",
    "parse_status": "string",
    "parse_error_message": "string",
    "processed_at": "string",
    "dedup_key": "string",
    "dedup_method": "string",
}


def typed(df: DataFrame, schema: dict[str, str] = LISTING) -> DataFrame:
    """df with every field of the schema: present ones cast, absent ones null of that type; other columns follow."""
    have = set(df.columns)
    fields = [(F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in schema.items()]
    return df.select(*fields, *(F.col(c) for c in df.columns if c not in schema))


def without_void(df: DataFrame) -> DataFrame:
    """Columns of no type become strings."""
    return df.select(*(F.col(c).cast("string").alias(c) if t == "void" else F.col(c) for c, t in df.dtypes))


def with_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """df with each absent column of wanted (name to type) as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})
