"""A star schema out of snapshots and daily quality: five dimensions and two facts, by column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, date_key, first_nonblank, hash_key, plain, slug

# The unknown member's key, and keys of known sources.
UNKNOWN = "0000000000000000"
SOURCE_KEYS = {"unknown": 0, "batdongsan": 1, "nhatot": 2}
SOURCE_DOMAINS = {"batdongsan": "batdongsan.com.vn", "nhatot": "nhatot.com"}
BUSINESS_TYPES = {"apartment": "residential", "house": "residential", "villa_townhouse": "residential", "land": "land", "commercial": "commercial"}


def _of(df: DataFrame, *names: str) -> Column:
    """The first non-blank of the named columns that df has."""
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return first_nonblank(*have) if have else F.lit(None).cast("string")


def source_key(code: Column, keys: dict[str, int] = SOURCE_KEYS) -> Column:
    """A source's key: by name, else by a known name within it or it within one, else 0."""
    out = F.lit(0)
    for name, key in reversed([x for x in keys.items() if x[0] != "unknown"]):
        out = F.when(code.contains(name) | F.lit(name).contains(code), key).otherwise(out)
    for name, key in keys.items():
        out = F.when(code == name, key).otherwise(out)
    return out.cast("int")


def dim_date(*columns: DataFrame) -> DataFrame:
    """One row for each date in the given one-column frames."""
    days = None
    for df in columns:
        own = df.select(F.try_to_date(F.col(df.columns[0]).cast("string")).alias("date_value"))
        days = own if days is None else days.unionByName(own)
    d = F.col("date_value")
    return days.filter("date_value is not null").distinct().select(
        date_key(d).alias("date_key"), "date_value", F.dayofmonth(d).alias("day_of_month"), (F.weekday(d) + 1).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"), (F.weekday(d) >= 5).alias("is_weekend"),
    )


def _codes(df: DataFrame, *names: str) -> DataFrame:
    return df.select(plain(_of(df, *names)).alias("code")).filter("code <> ''")


def dim_source(snap: DataFrame, quality: DataFrame, keys: dict[str, int] = SOURCE_KEYS) -> DataFrame:
    """Sources seen and `unknown`; of several with one key the first by name (but unknown first) stays."""
    spark = snap.sparkSession
    codes = _codes(snap, "source_code", "source").unionByName(_codes(quality, "source_code", "source")).unionByName(spark.sql("select 'unknown' as code")).distinct()
    known = [F.when(F.col("code").contains(n), d) for n, d in SOURCE_DOMAINS.items()]
    out = codes.select(
        source_key(F.col("code"), keys).alias("source_key"), F.col("code").alias("source_code"), F.initcap(F.replace("code", F.lit("_"), F.lit(" "))).alias("source_name"),
        F.coalesce(*known).alias("source_domain"), F.lit("website").alias("source_type"), F.coalesce(*known).isNotNull().alias("is_active"),
    )
    place = F.row_number().over(Window.partitionBy("source_key").orderBy(F.col("source_code") != "unknown", "source_code"))
    return out.withColumn("__place", place).filter("__place = 1").drop("__place")


def property_group(df: DataFrame) -> Column:
    """A row's type of property; the same in the dimension and the fact, so that keys always meet."""
    return F.coalesce(blank_to_null(plain(_of(df, "property_type_group", "property_type", "crawl_category"))), F.lit("unknown"))


def business_type(group: Column) -> Column:
    return F.coalesce(*(F.when(group == g, b) for g, b in BUSINESS_TYPES.items()), F.lit("unknown"))


def property_key(group: Column) -> Column:
    return F.when(group == "unknown", UNKNOWN).otherwise(hash_key(business_type(group), group))


def dim_property_type(snap: DataFrame) -> DataFrame:
    groups = snap.select(property_group(snap).alias("g")).unionByName(snap.sparkSession.sql("select 'unknown' as g")).distinct()
    b = business_type(F.col("g"))
    return groups.select(
        property_key(F.col("g")).alias("property_type_key"), b.alias("business_type"), F.col("g").alias("property_type_group"), F.col("g").alias("property_type_code"),
        F.initcap(F.replace("g", F.lit("_"), F.lit(" "))).alias("property_type_label"), (b == "residential").alias("is_residential"), (b == "land").alias("is_land"), (b == "commercial").alias("is_commercial"),
    )


def location(df: DataFrame) -> dict[str, Column]:
    """Names and codes of city, district and ward, and the location's key."""
    names = {"city": ("city_norm", "province_norm", "city", "city_name"), "district": ("district_norm", "district", "district_name"), "ward": ("ward_norm", "ward", "ward_name")}
    out: dict[str, Column] = {}
    for part, columns in names.items():
        name = F.coalesce(blank_to_null(plain(_of(df, *columns))), F.lit("Unknown"))
        out[f"{part}_name"], out[f"{part}_code"] = name, slug(name)
    codes = [out[f"{p}_code"] for p in names]
    nowhere = (codes[0] == "unknown") & (codes[1] == "unknown") & (codes[2] == "unknown")
    out["location_key"] = F.when(nowhere, UNKNOWN).otherwise(hash_key(F.lit("VN"), *codes))
    return out


def dim_location(snap: DataFrame) -> DataFrame:
    where = location(snap)
    rows = snap.select(*(c.alias(n) for n, c in where.items()))
    unknown = {n: UNKNOWN if n == "location_key" else "Unknown" if n.endswith("_name") else "unknown" for n in where}
    rows = rows.unionByName(snap.sparkSession.range(1).select(*(F.lit(x).alias(n) for n, x in unknown.items())))
    rows = rows.groupBy("location_key").agg(*(F.min(n).alias(n) for n in where if n != "location_key"))
    level = F.when(F.col("ward_code") != "unknown", "ward").when(F.col("district_code") != "unknown", "district").when(F.col("city_code") != "unknown", "city").otherwise("unknown")
    sure = F.when(F.col("ward_code") != "unknown", 1.0).when(F.col("district_code") != "unknown", 0.7).when(F.col("city_code") != "unknown", 0.4).otherwise(0.0)
    return rows.withColumns({"country_code": F.lit("VN"), "country_name": F.lit("Vietnam"), "location_level": level, "location_confidence": sure})


def identified(snap: DataFrame) -> DataFrame:
    """snap with source_code, listing key and identity columns; rows without source or identity go."""
    ident = blank_to_null(plain(_of(snap, "listing_id")))
    url = blank_to_null(plain(_of(snap, "listing_url", "final_detail_url")))
    key = blank_to_null(plain(_of(snap, "dedup_key")))
    out = snap.withColumns(
        {
            "k_source": blank_to_null(plain(_of(snap, "source_code", "source"))),
            "k_id": ident,
            "k_url": url,
            "k_value": F.coalesce(ident, url, key),
            "k_method": F.when(ident.isNotNull(), "listing_id").when(url.isNotNull(), "listing_url").otherwise("dedup_key"),
            "k_date": date_key(_of(snap, "snapshot_date", "crawl_date")),
        }
    )
    return out.filter("k_source is not null and k_value is not null").withColumn("listing_key", hash_key(F.col("k_source"), F.col("k_value")))


def dim_listing(snap: DataFrame) -> DataFrame:
    """One row for each listing: the first non-null value of each attribute by date, first and last date."""
    rows = identified(snap)
    order = F.struct("k_date", "dedup_key")
    first = lambda c, name: F.min_by(c, F.when(c.isNotNull(), order)).alias(name)
    attributes = {"project_name": "string", "building_name": "string", "direction": "string", "seller_type": "string"}
    width = F.coalesce(*(F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in ("frontage_width", "frontage_width_m") if c in rows.columns), F.lit(None).cast("double"))
    return rows.groupBy("listing_key").agg(
        F.min(source_key(F.col("k_source"))).alias("source_key"), first(F.col("k_id"), "source_listing_id"), first(F.col("k_url"), "source_listing_url"), first(F.col("dedup_key"), "dedup_key"),
        F.min("k_date").alias("first_seen_date_key"), F.max("k_date").alias("last_seen_date_key"), first(F.col("k_method"), "listing_identity_method"), first(width, "frontage_width_m"),
        *(first(blank_to_null(F.col(c)) if c in rows.columns else F.lit(None).cast(t), c) for c, t in attributes.items()),
    )


def fact_listing(snap: DataFrame) -> DataFrame:
    """One row for each date, source and listing, with the keys of all dimensions and the measures."""
    rows = identified(snap)
    numbers = ("price_vnd", "area_m2", "unit_price_vnd_m2", "bedroom_count", "bathroom_count", "floor_count", "quality_score", "price_change_vnd", "price_change_pct")
    flags = (
        "is_new_listing", "is_price_changed", "is_info_changed", "has_legal_info", "has_car_access", "is_price_negotiable", "has_red_pink_book", "is_business_suitable",
        "has_urban_area_flag", "has_security_flag", "has_educated_community_flag", "has_high_intellect_flag", "has_residential_area_flag", "has_subdivision_flag",
    )
    texts = ("legal_status_raw", "furniture_level", "car_access_type")
    where = location(rows)
    out = rows.select(
        F.col("k_date").alias("date_key"), source_key(F.col("k_source")).alias("source_key"), "listing_key", where["location_key"].alias("location_key"), property_key(property_group(rows)).alias("property_type_key"),
        *((F.col(c) if c in rows.columns else F.lit(None).cast("double")).alias(c) for c in numbers),
        F.coalesce(*(F.col(c).cast("double") for c in ("frontage_width_m", "frontage_width") if c in rows.columns), F.lit(None).cast("double")).alias("frontage_width_m"),
        *((F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False)).alias(c) for c in flags),
        *((blank_to_null(F.col(c).cast("string")) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in texts),
        F.coalesce(F.col("snapshot_status"), F.lit("unknown")).alias("snapshot_status"), (F.coalesce(F.col("snapshot_status"), F.lit("")) != "removed").alias("is_active_listing"),
        (F.coalesce(F.col("snapshot_status"), F.lit("")) == "removed").alias("is_removed_listing"), "dedup_key",
    )
    place = F.row_number().over(Window.partitionBy("date_key", "source_key", "listing_key").orderBy("dedup_key"))
    return out.withColumn("__place", place).filter("__place = 1").drop("__place")


def fact_quality(quality: DataFrame) -> DataFrame:
    """One row for each day and source; counts and rates default to 0."""
    counts = ("total_records", "parse_success_count", "duplicate_record_count", "missing_price_count", "missing_area_count", "missing_location_count", "quarantine_count")
    rates = ("parse_success_rate", "duplicate_rate", "missing_price_rate", "missing_area_rate", "missing_location_rate")
    have = lambda c, zero: (F.coalesce(F.col(c), zero) if c in quality.columns else zero).alias(c)
    out = quality.select(
        date_key(F.col("crawl_date")).alias("date_key"), source_key(plain(F.col("source"))).alias("source_key"),
        *(have(c, F.lit(0).cast("bigint")) for c in counts), *(have(c, F.lit(0.0)) for c in rates), have("publish_blocked_flag", F.lit(False)), F.col("source").alias("k"),
    )
    place = F.row_number().over(Window.partitionBy("date_key", "source_key").orderBy("k"))
    return out.withColumn("__place", place).filter("__place = 1").drop("__place", "k")
