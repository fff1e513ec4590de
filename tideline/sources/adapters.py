"""Canonical listings out of the test tables: an event is one capture of the listing of its user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import flags


def listings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, lit = F.col, F.lit
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    user, k = c("user_id").cast("string"), F.get_json_object("props", "$.k").cast("int")
    base = e.select(
        F.concat(lit("src"), (c("user_id") % 2).cast("string")).alias("source"),
        c("ts").cast("date").cast("string").alias("crawl_date"),
        F.concat(lit("c"), (c("event_id") % 3).cast("string")).alias("crawl_id"),
        F.when(c("user_id") % 10 != 0, user).alias("listing_id"),
        F.when(c("user_id") % 30 != 0, F.concat(lit("https://Ex.test/ad/"), user, lit("/?e="), c("event_id").cast("string"))).alias("listing_url"),
        F.concat(lit(" Ad "), user, lit(" ")).alias("title_raw"),
        F.concat(lit("k"), (k % 5).cast("string")).alias("description_raw"),
        F.when(c("event_type") != "error", F.round(c("value") * 100).cast("bigint")).alias("price_vnd"),
        F.when(c("event_type") == "signup", "negotiable").when(c("event_type") != "error", "vnd").alias("price_unit"),
        F.when(k >= 10, k.cast("double")).alias("area_m2"),
        F.when(c("user_id") % 3 != 0, F.concat(lit("city"), (c("user_id") % 2).cast("string"))).alias("city_norm"),
        F.when(k % 11 != 0, F.concat(lit("d"), (c("user_id") % 7).cast("string"))).alias("district_norm"),
        F.when(k % 4 == 0, lit("near")).alias("location_raw"),
        F.element_at(F.array(*map(lit, ("apartment", "house", "land", "street_house"))), (c("user_id") % 4 + 1).cast("int")).alias("property_type_group"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("processed_at"),
        c("event_id"),
    )
    no = lit(None).cast("string")
    made = flags(c("price_vnd"), c("price_unit"), c("area_m2"), c("location_raw"), c("district_norm"), c("city_norm"), lit(None).cast("boolean"), no)
    return base.withColumn("unit_price_vnd_m2", F.when(c("area_m2") > 0, c("price_vnd") / c("area_m2"))).withColumns(made)
