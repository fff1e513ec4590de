"""Checks as DataFrames of violations, and gates as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of a source's gate as (metric, least / most, bound), and the fewest records to publish.
SOURCE_GATE = (
    ("total_records", "minimum", 1),
    ("parse_success_rate", "minimum", 0.9),
    ("blocked_rate", "maximum", 0.5),
    ("missing_price_rate", "maximum", 0.5),
    ("missing_area_rate", "maximum", 0.5),
    ("missing_location_rate", "maximum", 0.5),
    ("duplicate_rate", "maximum", 0.5),
    ("quarantine_rate", "maximum", 0.5),
)
MIN_RECORDS = 100


def orphans(facts: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Rows whose key is null or not in dim."""
    return facts.join(dim.select(F.col(dim_key or key).alias(key)).distinct(), key, "left_anti")


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def date_differences(a: DataFrame, b: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """Values that only one side has: (value, side)."""
    x, y = a.select(F.col(column).alias("value")).distinct(), b.select(F.col(other or column).alias("value")).distinct()
    return x.join(y, "value", "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, "value", "left_anti").withColumn("side", F.lit("right")))


def missing_columns(df: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def gate_reasons(df: DataFrame, rules=SOURCE_GATE) -> Column:
    """Array of messages for the rules that a row breaks; a metric that is null or absent counts as 0."""
    tests = []
    for metric, kind, bound in rules:
        value = F.coalesce(F.col(metric).cast("double"), F.lit(0.0)) if metric in df.columns else F.lit(0.0)
        bad, side = (value < bound, "below") if kind == "minimum" else (value > bound, "above")
        shown = F.regexp_replace(F.format_string("%.6f", value), r"\.?0+$", "")
        tests.append(F.when(bad, F.concat(F.lit(f"{metric} "), shown, F.lit(f" {side} {kind} {bound:.6g}"))))
    return F.array_compact(F.array(*tests))


def source_gate(quality: DataFrame, rules=SOURCE_GATE) -> DataFrame:
    """quality with gate_reasons and gate (`pass` or `fail`)."""
    return quality.withColumn("gate_reasons", gate_reasons(quality, rules)).withColumn("gate", F.when(F.size("gate_reasons") == 0, "pass").otherwise("fail"))


def publish_gate(skipped: Column, status: Column, valid: Column, records: Column, warnings: Column, least: int = MIN_RECORDS) -> Column:
    """struct(decision, reason): skipped, blocked with the first reason, published with warnings, or published."""
    pair = lambda a, b: F.struct(F.lit(a).alias("decision"), F.lit(b).alias("reason"))
    return (
        F.when(skipped, pair("skipped", "publish skipped"))
        .when(~status.eqNullSafe("success"), pair("blocked", "pipeline status"))
        .when(~F.coalesce(valid, F.lit(False)), pair("blocked", "validation"))
        .when(F.coalesce(records, F.lit(0)) == 0, pair("blocked", "no records"))
        .when(records < least, pair("blocked", "too few records"))
        .when(warnings > 0, pair("published_with_warnings", "warnings"))
        .otherwise(pair("published", ""))
    )


def quality_class(parse: Column, duplicates: Column) -> Column:
    """Class of a day by fixed bounds."""
    return F.when((parse >= 0.95) & (duplicates < 0.1), "excellent").when(parse >= 0.9, "good").otherwise("poor")


def quality_class_to_baseline(parse: Column, base: Column, rates: list[tuple[Column, Column]]) -> Column:
    """Class of a day by its rolling baseline: floors under the parse rate, and rates that may not rise by .05 or .10."""
    rise = lambda by: [F.coalesce(r <= b + by, F.lit(True)) for r, b in rates]
    every = lambda tests: F.forall(F.array(*tests), lambda x: x) if tests else F.lit(True)
    return F.when((parse >= F.greatest(F.lit(0.95), base - 0.02)) & every(rise(0.05)), "excellent").when((parse >= F.greatest(F.lit(0.90), base - 0.05)) & every(rise(0.10)), "good").otherwise("poor")
