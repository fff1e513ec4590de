"""From captures to days: keys, duplicates, one row a day, lifecycles, changes and removals.

Rows are exchanged by dedup_key once (`duplicate_flags` asks for it): windows over days and keys, over keys, and latest
rows all find their rows together, as a key's rows of a day are among the key's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import identity
from ..functions.quality import score
from ..schema import typed

TRACKED = ("price_vnd", "area_m2", "title_raw", "description_raw", "district_norm", "property_type_group")


def keyed(listings: DataFrame) -> DataFrame:
    """Canonical listings with dedup_key and dedup_method."""
    return typed(listings).withColumns(identity())


def duplicate_flags(df: DataFrame) -> DataFrame:
    """duplicate_group_size (rows of the same day and key; null without a day) and is_duplicate_in_snapshot."""
    df = df.repartition("dedup_key")  # the one exchange: all later windows are by dedup_key, or by it and the day
    n = F.when(F.col("crawl_date").isNotNull(), F.count("*").over(Window.partitionBy("crawl_date", "dedup_key")))
    return df.withColumn("duplicate_group_size", n).withColumn("is_duplicate_in_snapshot", F.col("duplicate_group_size") > 1)


def best_of_day(df: DataFrame, tiebreak: str | Column | None = None) -> DataFrame:
    """One row for each day and key: the best score, then the latest processed_at, crawl_id and listing_url, then the
    tiebreak (any total order; by default a hash of the row)."""
    df = df.withColumn("quality_score", score())
    last = F.xxhash64(*df.columns) if tiebreak is None else F.col(tiebreak) if isinstance(tiebreak, str) else tiebreak
    order = [F.col("quality_score").desc(), *(F.col(c).desc_nulls_last() for c in ("processed_at", "crawl_id", "listing_url")), last.desc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("crawl_date", "dedup_key").orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def lifecycle(daily: DataFrame) -> DataFrame:
    """First and last day of each key and its days; daily has one row for each day and key, so days are a plain count."""
    return daily.groupBy("dedup_key").agg(F.min("crawl_date").alias("first_seen_date"), F.max("crawl_date").alias("last_seen_date"), F.count("crawl_date").alias("active_days"))


def snapshots(daily: DataFrame) -> DataFrame:
    """daily with its key's lifecycle, is_new_listing, and status `new` or `active`; the day is snapshot_date."""
    life = Window.partitionBy("dedup_key")
    out = daily.withColumns({"first_seen_date": F.min("crawl_date").over(life), "last_seen_date": F.max("crawl_date").over(life), "active_days": F.count("crawl_date").over(life)})
    out = out.withColumn("is_new_listing", F.col("crawl_date") == F.col("first_seen_date"))
    return out.withColumn("snapshot_status", F.when(F.col("is_new_listing"), "new").otherwise("active")).withColumnRenamed("crawl_date", "snapshot_date")


def price_changes(snap: DataFrame) -> DataFrame:
    """Price before, difference, difference as a share, is_price_changed, and status `changed_price`. A negotiable or
    unknown unit is no change."""
    before, now = F.lag("price_vnd").over(Window.partitionBy("dedup_key").orderBy("snapshot_date")), F.col("price_vnd")
    out = snap.withColumn("previous_price_vnd", before).withColumn("current_price_vnd", now)
    before = F.col("previous_price_vnd")
    out = out.withColumns(
        {
            "price_change_vnd": now - before,
            "price_change_pct": F.when(before != 0, (now - before) / before),
            "is_price_changed": F.coalesce((before != now) & (F.col("price_unit") != "negotiable"), F.lit(False)),
        }
    )
    changed = F.col("is_new_listing").eqNullSafe(False) & F.col("is_price_changed")
    return out.withColumn("snapshot_status", F.when(changed, "changed_price").otherwise(F.col("snapshot_status")))


def info_changes(snap: DataFrame, fields: tuple[str, ...] = TRACKED) -> DataFrame:
    """For each field its value before and whether both are there and differ; changed_fields and is_info_changed."""
    fields = tuple(f for f in fields if f in snap.columns)
    days = Window.partitionBy("dedup_key").orderBy("snapshot_date")
    out = snap.withColumns({f"previous_{f}": F.lag(f).over(days) for f in fields})
    out = out.withColumns({f"is_{f}_changed": F.coalesce(F.col(f"previous_{f}").cast("string") != F.col(f).cast("string"), F.lit(False)) for f in fields})
    names = F.concat_ws(",", *(F.when(F.col(f"is_{f}_changed"), f) for f in fields)) if fields else F.lit("")
    return out.withColumn("changed_fields", names).withColumn("is_info_changed", F.col("changed_fields") != "")


def removed(daily: DataFrame, per_source: bool = False, captures: DataFrame | None = None) -> DataFrame:
    """Keys seen on a day but not on the next day that has any rows (with per_source, any of the same source): rows of
    daily with that next day as snapshot_date, last_seen_before_removed, status `removed`. captures: a table with the same
    days (what daily was made of), so that finding them reads only its day column and not all that daily takes.

    Days are few beside rows; their successors come from a window over distinct days, and the join is left to the
    optimiser, which broadcasts them while they are small. A key's own next day is a lag window, so no second exchange.
    """
    by = ["source"] if per_source else []
    days = (daily if captures is None else captures).filter("crawl_date is not null").select(*by, "crawl_date").distinct()
    order = Window.partitionBy(*by).orderBy("crawl_date")
    days = days.withColumn("snapshot_date", F.lead("crawl_date").over(order)).filter("snapshot_date is not null")
    own = F.lead("crawl_date").over(Window.partitionBy("dedup_key").orderBy("crawl_date"))
    out = daily.filter("crawl_date is not null").withColumn("__own_next", own).join(days, [*by, "crawl_date"])
    out = out.filter(F.col("__own_next").isNull() | (F.col("__own_next") > F.col("snapshot_date"))).drop("__own_next")
    return out.select(*daily.columns, "snapshot_date", F.col("crawl_date").alias("last_seen_before_removed"), F.lit("removed").alias("snapshot_status"), F.lit(True).alias("is_removed_listing"))
