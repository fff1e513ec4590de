"""What surrounds a run: targets, routing, totals, scorecards, and checks of its tables against each other."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .marts import rate

# Rows of an API page; keys that mark a detail record.
PAGE_ROWS = 20
DETAIL_KEYS = ("subject", "body", "detail_address")


def transaction(business: Column, category: Column) -> Column:
    """`s` for sales, `u` for rents, else null."""
    kind, path = F.lower(F.coalesce(business, F.lit(""))), F.lower(F.coalesce(category, F.lit("")))
    return F.when((kind == "sale") | path.startswith("mua-ban"), "s").when(kind.isin("rent", "lease") | path.startswith("cho-thue"), "u")


def parser_of(source: Column) -> Column:
    """Which parser a row's source needs."""
    return F.when(F.lower(F.trim(source)) == "nhatot", "api").otherwise("page")


def expanded_targets(locations: DataFrame, categories: DataFrame) -> DataFrame:
    """Each location with each category; a location with categories of its own (array column) has only those. Both are
    small configuration tables."""
    own = "categories" in locations.columns
    every = categories.agg(F.array_sort(F.collect_set("category")).alias("every"))
    listed = F.coalesce(F.when(F.size("categories") > 0, F.col("categories")), F.col("every")) if own else F.col("every")
    rest = [c for c in locations.columns if c != "categories"]
    return locations.join(F.broadcast(every)).select(*rest, F.explode(listed).alias("category"))


def api_totals(totals: DataFrame, *by: str) -> DataFrame:
    """Announced ads and pages of API totals (column total)."""
    return totals.groupBy(*by).agg(F.sum("total").alias("ads"), F.sum(F.ceil(F.col("total") / PAGE_ROWS)).alias("pages"))


def file_sizes(spark: SparkSession, glob: str) -> DataFrame:
    """Number, mean, least and greatest size, and distinct paths of files; their contents aren't read."""
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    return files.agg(F.count("*").alias("files"), F.avg("length").alias("avg_bytes"), F.min("length").alias("min_bytes"), F.max("length").alias("max_bytes"), F.count_distinct("path").alias("paths"))


def _first_record(value, keys: tuple[str, ...]):
    if isinstance(value, dict) and any(k in value for k in keys):
        return value
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return next((found for x in inner if (found := _first_record(x, keys)) is not None), None)


def first_record(document: Column, keys: tuple[str, ...] = DETAIL_KEYS) -> Column:
    """The first object of a JSON text, depth first, that has one of the keys, as JSON; null without one. There is no
    built-in function that searches to any depth, so this runs in Arrow batches."""

    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                found = _first_record(json.loads(text), keys) if text else None
            except (ValueError, RecursionError):
                return None
            return None if found is None else json.dumps(found, ensure_ascii=False)

        return texts.map(one)

    return find(document)


def flag_summary(silver: DataFrame, inputs: int) -> DataFrame:
    """One row: records, the share of inputs that became records, and the share of each flag column."""
    flags = [c for c, t in silver.dtypes if t == "boolean" and c.startswith("is_")]
    out = silver.agg(F.count("*").alias("total_records"), *(F.avg(F.col(c).cast("double")).alias(f"{c}_rate") for c in flags))
    return out.withColumn("parse_success_rate", rate(F.col("total_records"), F.lit(inputs)))


def scorecard(runs: DataFrame) -> DataFrame:
    """Metrics of a run under the first of their names that it has, with quarantine and block rates."""
    names = {
        "total_records": ("total_records", "total_silver_records"),
        "parse_success_rate": ("parse_success_rate",),
        "duplicate_rate": ("duplicate_rate", "duplicate_record_rate"),
        "quarantine_count": ("quarantine_count", "quarantined"),
        "blocked": ("blocked", "blocked_count"),
        "requests": ("requests", "total_requests"),
    }
    picked = {n: F.coalesce(*(F.col(c) for c in cs if c in runs.columns), F.lit(None).cast("double")) for n, cs in names.items()}
    out = runs.select(*(c for c in runs.columns if c not in picked), *(v.cast("double").alias(n) for n, v in picked.items()))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return out.withColumns({"quarantine_rate": rate(zero("quarantine_count"), zero("quarantine_count") + zero("total_records")), "blocked_rate": rate(zero("blocked"), zero("requests"))})


def table_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations between a run's tables by name: current rows against keys, marts against snapshots, days of each."""
    snap, now = tables["snapshots"], tables["current_listings"]
    keys = snap.agg(F.count_distinct("dedup_key").alias("n"))
    found = {
        "current_rows": keys.crossJoin(now.agg(F.count("*").alias("m"))).select((F.col("n") - F.col("m")).alias("v")),
        "market_rows": snap.agg(F.count("*").alias("n")).crossJoin(tables["market_by_type"].agg(F.coalesce(F.sum("listing_count"), F.lit(0)).alias("m"))).select((F.col("n") - F.col("m")).alias("v")),
        "market_days": tables["market_by_district"].select("snapshot_date").distinct().join(snap.select("snapshot_date").distinct(), "snapshot_date", "left_anti").agg(F.count("*").alias("v")),
        "quality_days": snap.select(F.col("snapshot_date").alias("d")).distinct().join(tables["data_quality"].select(F.col("crawl_date").alias("d")).distinct(), "d", "left_anti").agg(F.count("*").alias("v")),
    }
    out = None
    for name, df in found.items():
        row = df.select(F.lit(name).alias("check"), F.abs("v").cast("long").alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out
