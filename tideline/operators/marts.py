"""Aggregates over snapshots and captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def current(snap: DataFrame) -> DataFrame:
    """The latest row of each key, also of keys since removed."""
    place = F.row_number().over(Window.partitionBy("dedup_key").orderBy(F.col("snapshot_date").desc()))
    return snap.withColumn("__place", place).filter("__place = 1").drop("__place")


def median(column: str, exact: bool = True) -> Column:
    """The lower middle value; without exact, a sketch of the same, which large groups need."""
    return F.expr(f"percentile_disc(0.5) within group (order by {column})" if exact else f"percentile_approx({column}, 0.5)")


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("snapshot_status") == "new").alias("new_listing_count"),
        F.count_if(F.col("is_price_changed")).alias("price_changed_count"),
        F.count_if(F.col("price_unit") == "negotiable").alias("negotiable_price_count"),
    ]


def _medians(exact: bool) -> list[Column]:
    return [median(c, exact).alias(f"median_{c}") for c in ("price_vnd", "area_m2", "unit_price_vnd_m2")]


def market_by_district(snap: DataFrame, exact: bool = True) -> DataFrame:
    rows = snap.filter("snapshot_status <> 'removed'").groupBy("snapshot_date", "city_norm", "district_norm", "property_type_group")
    return rows.agg(F.count("*").alias("listing_count"), *_medians(exact), F.avg("price_vnd").alias("avg_price_vnd"), F.avg("unit_price_vnd_m2").alias("avg_unit_price_vnd_m2"), *_counts())


def market_by_type(snap: DataFrame, exact: bool = True) -> DataFrame:
    rows = snap.filter("snapshot_status <> 'removed'").groupBy("snapshot_date", "property_type_group")
    return rows.agg(F.count("*").alias("listing_count"), *_medians(exact), F.avg("price_vnd").alias("avg_price_vnd"), *_counts())


#: Counted flags, and the columns that they count.
QUALITY = {
    "missing_price": "is_missing_price",
    "negotiable_price": "is_price_negotiable",
    "missing_area": "is_missing_area",
    "missing_location": "is_missing_location",
    "invalid_price": "is_invalid_price",
    "invalid_area": "is_invalid_area",
}


def data_quality(flagged: DataFrame) -> DataFrame:
    """Counts and rates of each day and source over all captures, duplicates included."""
    counts = [F.count_if(F.col(c)).alias(f"{n}_count") for n, c in QUALITY.items()]
    out = flagged.groupBy("crawl_date", "source").agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("parse_status") == "success").alias("parse_success_count"),
        *counts,
        F.count_if(F.col("is_duplicate_in_snapshot")).alias("duplicate_record_count"),
        F.count_distinct("dedup_key").alias("distinct_dedup_key_count"),
    )
    rates = {"parse_success_rate": "parse_success_count", **{f"{n}_rate": f"{n}_count" for n in QUALITY}, "duplicate_rate": "duplicate_record_count"}
    return out.withColumns({r: F.col(c) / F.col("total_records") for r, c in rates.items()})


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is no whole."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def summary(quality: DataFrame, current_rows: DataFrame, snap: DataFrame, removed_rows: DataFrame) -> DataFrame:
    """One row of totals, safe rates and days of a run; no table is read by the driver."""
    names = ("total_records", "parse_success_count", "missing_price_count", "negotiable_price_count", "missing_area_count", "missing_location_count", "duplicate_record_count")
    totals = quality.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    whole = F.col("total_records")
    totals = totals.withColumns({n.replace("_count", "_rate").replace("_record_rate", "_rate"): rate(F.col(n), whole) for n in names[1:]})
    rows = current_rows.agg(F.count("*").alias("current_rows")).crossJoin(snap.agg(F.count("*").alias("snapshot_rows"), F.array_join(F.array_sort(F.collect_set("snapshot_date")), ",").alias("snapshot_dates")))
    return totals.crossJoin(rows).crossJoin(removed_rows.agg(F.count("*").alias("removed_rows")))


def count_by(df: DataFrame, *columns: str, name: str = "n", unknown: str | None = None) -> DataFrame:
    """Rows by columns; with unknown, nulls and blanks count under that name."""
    by = [F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(unknown)).alias(c) if unknown else F.col(c) for c in columns]
    return df.groupBy(*by).agg(F.count("*").alias(name))


def explored(df: DataFrame, among: dict[str, list] | None = None, negotiable: bool | None = None, price_range: tuple | None = None, flags: dict[str, bool] | None = None) -> DataFrame:
    """Listings by choices: columns among values; only negotiable prices or none such (an unknown unit is none); prices in
    a range, its ends too, or unknown; flags that are set (True) or not known to be set (False)."""
    for column, values in (among or {}).items():
        df = df.filter(F.col(column).isin(*values))
    if negotiable is not None:
        kept = F.col("price_unit").eqNullSafe("negotiable")
        df = df.filter(kept if negotiable else ~kept)
    if price_range is not None:
        df = df.filter(F.col("price_vnd").between(*price_range) | F.col("price_vnd").isNull())
    for column, wanted in (flags or {}).items():
        kept = F.col(column).eqNullSafe(True)
        df = df.filter(kept if wanted else ~kept)
    return df


def duplicate_summary(flagged: DataFrame) -> DataFrame:
    """Of each day: rows, groups of duplicates, and rows in them."""
    groups = F.count_distinct(F.when(F.col("is_duplicate_in_snapshot"), F.col("dedup_key"))).alias("duplicate_groups")
    return flagged.groupBy("crawl_date").agg(F.count("*").alias("rows"), F.count_if("is_duplicate_in_snapshot").alias("duplicate_rows"), groups)


def top_districts(market: DataFrame, k: int = 20) -> DataFrame:
    """Districts with the most listings over all days."""
    return market.filter("district_norm is not null").groupBy("district_norm").agg(F.sum("listing_count").alias("listings")).orderBy(F.col("listings").desc(), "district_norm").limit(k)


def top_median_districts(market: DataFrame, k: int = 20) -> DataFrame:
    """Districts with the greatest median of daily medians."""
    rows = market.filter("district_norm is not null and median_price_vnd is not null").groupBy("district_norm")
    return rows.agg(F.median("median_price_vnd").alias("median_of_medians")).orderBy(F.col("median_of_medians").desc(), "district_norm").limit(k)


def melted(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Long form of columns, for trends."""
    return df.unpivot(ids, values, name, value)


def baseline(df: DataFrame, order: str, metrics: list[str], rows: int = 7, by: list[str] | None = None) -> DataFrame:
    """Mean of each metric over the rows before (nulls skipped), difference to it, and difference as a share."""
    frame = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(-rows, -1)
    out = df.withColumns({f"{m}_baseline": F.avg(m).over(frame) for m in metrics})
    deltas = {f"{m}_delta": F.col(m) - F.col(f"{m}_baseline") for m in metrics}
    shares = {f"{m}_delta_pct": F.when(F.col(f"{m}_baseline") != 0, (F.col(m) - F.col(f"{m}_baseline")) / F.col(f"{m}_baseline")) for m in metrics}
    return out.withColumns(deltas | shares)
