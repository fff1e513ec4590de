"""Jobs that build, check and write whole layers: gold tables out of listings, and the star schema out of gold."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import plain
from ..operators import readiness
from ..schema import without_void
from ..sources import sinks
from ..sources.tables import exists
from . import gold, warehouse

SCHEMA_VERSION = "warehouse_v1"
#: Tables partitioned by a column, and the order of their samples.
PARTITIONS = {"snapshots": "snapshot_date", "removed_listings": "snapshot_date", "market_by_district": "snapshot_date", "data_quality": "crawl_date"}
SAMPLES = {"current_listings": ["dedup_key"], "snapshots": ["snapshot_date", "dedup_key"], "removed_listings": ["snapshot_date", "dedup_key"], "data_quality": ["crawl_date", "source"]}
SORTED = {
    "dim_date": ("date_key",), "dim_source": ("source_key",), "dim_property_type": ("property_type_key",), "dim_location": ("location_key",), "dim_listing": ("listing_key",),
    "fact_listing": ("date_key", "source_key", "listing_key"), "fact_quality": ("date_key", "source_key"),
}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A written table in its own schema (a small file beside its data, which Spark passes over), so that an empty one can
    be read and partition columns have their types; without it as Spark infers."""
    if not exists(spark, f"{path}/_schema"):
        return spark.read.parquet(path)
    return spark.read.schema(StructType.fromJson(json.loads(sinks.read_text(spark, f"{path}/_schema")))).parquet(path)


def _write(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    df = without_void(df)
    sinks.write_table(df, path, by, whole=True)
    sinks.write_json(df.sparkSession, df.schema.json(), f"{path}/_schema")
    return _read(df.sparkSession, path)


def read_gold(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The gold tables under base."""
    out = {}
    for name in gold.Run.NAMES:
        if name != "summary" and exists(spark, f"{base}/{name}"):
            out[name] = _read(spark, f"{base}/{name}")
    if exists(spark, f"{base}/summary.json"):
        out["summary"] = spark.read.json(f"{base}/summary.json")
    return out


def build_gold(listings: DataFrame, base: str, tiebreak: str | Column | None = None, samples: bool = True) -> dict[str, DataFrame]:
    """Writes all gold tables and summary.json under base and returns them as read back.

    Rows with keys and the best rows of days are written first, then snapshots; everything else is made of these files,
    so no window is computed twice.
    """
    spark, run = listings.sparkSession, gold.Run(listings, tiebreak)
    for name in gold.Run.NAMES[:-1]:
        # What follows is made of the written table.
        setattr(run, name, _write(run[name], f"{base}/{name}", [PARTITIONS[name]] if name in PARTITIONS else []))
        if samples and name in SAMPLES:
            sinks.write_sample(run[name], f"{base}/{name}_csv_sample", SAMPLES[name])
    made = F.array(*map(F.lit, gold.Run.NAMES[:-1]))
    sinks.write_summary(run["summary"].withColumn("tables", made), f"{base}/summary.json")
    return read_gold(spark, base)


def check_gold(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks of written gold tables."""
    made = [name for name in tables if name != "summary"]
    return readiness.summary_checks(tables["summary"], made).unionByName(readiness.gold_checks(tables, tables["summary"]))


def star_tables(snap: DataFrame, quality: DataFrame, keys: dict[str, int] = warehouse.SOURCE_KEYS) -> dict[str, DataFrame]:
    """The seven tables out of snapshots (or current listings) and daily quality."""
    day = "snapshot_date" if "snapshot_date" in snap.columns else "crawl_date"
    return {
        "dim_date": warehouse.dim_date(snap.select(day), quality.select("crawl_date")),
        "dim_source": warehouse.dim_source(snap, quality, keys),
        "dim_property_type": warehouse.dim_property_type(snap),
        "dim_location": warehouse.dim_location(snap),
        "dim_listing": warehouse.dim_listing(snap),
        "fact_listing": warehouse.fact_listing(snap),
        "fact_quality": warehouse.fact_quality(quality),
    }


def star_summary(tables: dict[str, DataFrame], snap: DataFrame, quality: DataFrame) -> DataFrame:
    """One row: row counts of the tables, days of snapshots and of captures, codes of sources with `unknown` first."""
    counts = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n")
        counts = row if counts is None else counts.unionByName(row)
    day = "snapshot_date" if "snapshot_date" in snap.columns else "crawl_date"
    days = lambda df, c, name: df.agg(F.array_sort(F.collect_set(F.try_to_date(F.col(c).cast("string")).cast("string"))).alias(name))
    codes = [df.select(plain(F.col("source")).alias("code")) for df in (snap, quality)]
    codes = codes[0].unionByName(codes[1]).filter("code not in ('', 'unknown')").agg(F.array_sort(F.collect_set("code")).alias("c"))
    out = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n")))).alias("table_row_counts"))
    out = out.crossJoin(days(snap, day, "snapshot_dates")).crossJoin(days(quality, "crawl_date", "crawl_dates")).crossJoin(codes)
    return out.select(
        F.lit(SCHEMA_VERSION).alias("warehouse_schema_version"), "table_row_counts", "snapshot_dates", "crawl_dates", F.concat(F.array(F.lit("unknown")), "c").alias("source_codes"),
        F.array(*map(F.lit, tables)).alias("warehouse_tables_created"), F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("created_at"),
    )


def build_warehouse(spark: SparkSession, gold_base: str, base: str, keys: dict[str, int] = warehouse.SOURCE_KEYS) -> dict[str, DataFrame]:
    """Builds the star tables of the gold tables under gold_base, writes them under base in the order of their keys, with a
    CSV sample of each and warehouse_summary.json, and returns them as read back."""
    found = read_gold(spark, gold_base)
    snap = found["snapshots"] if "snapshots" in found else found["current_listings"]
    quality = found["data_quality"]
    for name, df in star_tables(snap, quality, keys).items():
        # Files are sorted and hold ranges of keys, so readers skip by their statistics; no task holds a whole table.
        df.repartitionByRange(*SORTED[name]).sortWithinPartitions(*SORTED[name]).write.mode("overwrite").parquet(f"{base}/{name}")
    tables = {name: spark.read.parquet(f"{base}/{name}") for name in SORTED}
    for name, df in tables.items():
        sinks.write_sample(df, f"{base}/{name}_csv_sample", SORTED[name])
    sinks.write_summary(star_summary(tables, snap, quality), f"{base}/warehouse_summary.json")
    return tables


def check_warehouse(spark: SparkSession, tables: dict[str, DataFrame], gold_base: str, base: str) -> DataFrame:
    """All checks of written star tables, with their summary's counts and the gold snapshots."""
    counts = spark.read.json(f"{base}/warehouse_summary.json").select("table_row_counts.*").first().asDict()
    found = read_gold(spark, gold_base)
    snap = found["snapshots"] if "snapshots" in found else found["current_listings"]
    return readiness.warehouse_checks(tables, counts).unionByName(readiness.grain_check(tables["fact_listing"], snap))


def run(listings: DataFrame, base: str, tiebreak: str | Column | None = None, strict: bool = True) -> DataFrame:
    """Gold, its checks, the warehouse, its checks, under base/gold and base/warehouse. Returns all checks; with strict, a
    broken one stops the job before what depends on it is built."""
    spark = listings.sparkSession
    made = build_gold(listings, f"{base}/gold", tiebreak)
    found = check_gold(made)
    if strict:
        readiness.require(found)
    tables = build_warehouse(spark, f"{base}/gold", f"{base}/warehouse")
    stars = check_warehouse(spark, tables, f"{base}/gold", f"{base}/warehouse")
    if strict:
        readiness.require(stars)
    return found.withColumn("layer", F.lit("gold")).unionByName(stars.withColumn("layer", F.lit("warehouse")))


def publish(spark: SparkSession, warehouse_base: str, gold_base: str, base: str) -> DataFrame:
    """Checks the written star tables, then exports them as CSV with a byte order mark, and a manifest."""
    tables = {name: spark.read.parquet(f"{warehouse_base}/{name}") for name in SORTED}
    readiness.require(check_warehouse(spark, tables, gold_base, warehouse_base))
    sinks.export_csv(tables, base, bom=True)
    return sinks.export_manifest(spark, tables, tables["dim_date"].select("date_value"), f"{base}/manifest.json")
