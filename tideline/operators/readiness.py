"""Whether written tables are fit to use: each check is a row (check, violations), so none needs the driver to read data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import checks

# Rates of a summary that lie between 0 and 1, totals that are positive, and for each gold table the fewest
# rows and the columns that it has.
RATES = ("duplicate_rate", "parse_success_rate", "missing_price_rate", "missing_area_rate", "missing_location_rate")
TOTALS = ("total_records", "current_rows")
GOLD = {
    "current_listings": (1, ("dedup_key", "source", "snapshot_date", "snapshot_status")),
    "snapshots": (1, ("dedup_key", "snapshot_date", "snapshot_status", "is_new_listing", "is_price_changed")),
    "market_by_district": (1, ("snapshot_date", "district_norm", "property_type_group", "listing_count")),
    "market_by_type": (1, ("snapshot_date", "property_type_group", "listing_count")),
    "data_quality": (1, ("crawl_date", "source", "total_records", "parse_success_rate")),
    "removed_listings": (0, ("dedup_key", "snapshot_date", "snapshot_status")),
}
WAREHOUSE = {
    "dim_date": (1, ("date_key", "date_value", "year", "month")),
    "dim_source": (1, ("source_key", "source_code")),
    "dim_property_type": (1, ("property_type_key", "property_type_group")),
    "dim_location": (1, ("location_key", "city_code", "district_code", "ward_code")),
    "dim_listing": (1, ("listing_key", "source_key", "first_seen_date_key", "last_seen_date_key")),
    "fact_listing": (1, ("date_key", "source_key", "listing_key", "location_key", "property_type_key")),
    "fact_quality": (1, ("date_key", "source_key", "total_records")),
}
UNKNOWN = {"dim_source": ("source_key", 0), "dim_property_type": ("property_type_key", "0" * 16), "dim_location": ("location_key", "0" * 16)}
KEYS = {
    "dim_date": ("date_key",),
    "dim_source": ("source_key",),
    "dim_property_type": ("property_type_key",),
    "dim_location": ("location_key",),
    "dim_listing": ("listing_key",),
    "fact_listing": ("date_key", "source_key", "listing_key"),
    "fact_quality": ("date_key", "source_key"),
}
REFERENCES = (
    ("dim_listing", "source_key", "dim_source", "source_key"),
    ("dim_listing", "first_seen_date_key", "dim_date", "date_key"),
    ("dim_listing", "last_seen_date_key", "dim_date", "date_key"),
    ("fact_listing", "date_key", "dim_date", "date_key"),
    ("fact_listing", "source_key", "dim_source", "source_key"),
    ("fact_listing", "listing_key", "dim_listing", "listing_key"),
    ("fact_listing", "location_key", "dim_location", "location_key"),
    ("fact_listing", "property_type_key", "dim_property_type", "property_type_key"),
    ("fact_quality", "date_key", "dim_date", "date_key"),
    ("fact_quality", "source_key", "dim_source", "source_key"),
)


def _row(df: DataFrame, name: str, violations) -> DataFrame:
    """One row out of an aggregate of df, or of its rows if violations is None."""
    made = F.count("*") if violations is None else violations
    return df.agg(made.cast("long").alias("violations")).select(F.lit(name).alias("check"), "violations")


def _all(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def summary_checks(summary: DataFrame, tables: list[str], wanted=GOLD) -> DataFrame:
    """Checks of a run's one-row summary: absent fields, totals that aren't positive, rates out of range, tables that
    weren't made."""
    spark = summary.sparkSession
    lacking = [c for c in (*TOTALS, *RATES, "snapshot_dates") if c not in summary.columns]
    out = {"absent_fields": F.lit(len(lacking)), "absent_tables": F.lit(len(set(wanted) - set(tables)))}
    for c in TOTALS:
        out[f"{c}_positive"] = F.sum(F.when(F.coalesce(F.col(c), F.lit(0)) > 0, 0).otherwise(1)) if c in summary.columns else F.lit(1)
    for c in RATES:
        out[f"{c}_in_range"] = F.sum(F.when(F.col(c).between(0, 1), 0).otherwise(1)) if c in summary.columns else F.lit(1)
    row = summary.agg(*(F.coalesce(v, F.lit(1)).cast("long").alias(k) for k, v in out.items()))
    return row.unpivot([], list(out), "check", "violations") if spark else row


def gold_checks(tables: dict[str, DataFrame], summary: DataFrame, wanted=GOLD) -> DataFrame:
    """Checks of a run's tables: rows under the minimum, absent columns, current rows against the summary, and days: those
    of current and removed listings are among the summary's, those of other tables are the same."""
    days = summary.select(F.explode(F.split("snapshot_dates", ",")).alias("day")).filter("day <> ''")
    rows = []
    for name, (least, columns) in wanted.items():
        df = tables[name]
        rows.append(_row(df, f"{name}_rows", F.when(F.count("*") < least, 1).otherwise(0)))
        lacking = len(checks.missing_columns(df, columns))
        rows.append(_row(summary, f"{name}_columns", F.count("*") * lacking))
        column = "crawl_date" if name == "data_quality" else "snapshot_date"
        if column in df.columns:
            found = checks.date_differences(df.filter(F.col(column).isNotNull()), days, column, "day")
            if name in ("current_listings", "removed_listings"):
                found = found.filter("side = 'left'")
            rows.append(_row(found, f"{name}_days", None))
    rows.append(_row(summary.select("current_rows").unionByName(tables["current_listings"].agg((-F.count("*")).alias("current_rows"))), "current_rows_match", F.abs(F.sum("current_rows"))))
    return _all(rows)


def warehouse_checks(tables: dict[str, DataFrame], counts: dict[str, int] | None = None, wanted=WAREHOUSE) -> DataFrame:
    """Checks of the star tables: rows under the minimum, absent columns, repeated keys, absent unknown members, keys that
    their dimension lacks, and row counts other than the summary's."""
    rows = []
    for name, (least, columns) in wanted.items():
        df = tables[name]
        total = F.count("*")
        rows.append(_row(df, f"{name}_rows", F.when(total < least, 1).otherwise(0)))
        rows.append(_row(df, f"{name}_columns", F.when(total >= 0, len(checks.missing_columns(df, columns)))))
        rows.append(_row(checks.repeated(df, *KEYS[name]), f"{name}_repeated", None))
        if counts is not None and name in counts:
            rows.append(_row(df, f"{name}_count", F.abs(total - counts[name])))
    for name, (column, value) in UNKNOWN.items():
        rows.append(_row(tables[name], f"{name}_unknown", F.when(F.count_if(F.col(column) == value) > 0, 0).otherwise(1)))
    for name, column, dim, key in REFERENCES:
        rows.append(_row(checks.orphans(tables[name], column, tables[dim], key), f"{name}_{column}_orphans", None))
    return _all(rows)


def grain_check(facts: DataFrame, snap: DataFrame) -> DataFrame:
    """Difference of fact rows to distinct snapshots by those of date, source, dedup_key and listing_id that are there."""
    grain = [c for c in ("snapshot_date", "source", "dedup_key", "listing_id") if c in snap.columns]
    distinct = (snap.select(*grain).distinct() if grain else snap).agg(F.count("*").alias("n"))
    both = distinct.unionByName(facts.agg((-F.count("*")).alias("n")))
    return _row(both, "fact_grain", F.abs(F.sum("n")))


def silver_checks(silver: DataFrame, source: str, least: int = 0) -> DataFrame:
    """Checks of one source's parsed listings: rows under the minimum, no column of origin, and rows of another origin."""
    origin = [c for c in ("source", "source_code") if c in silver.columns]
    rows = [_row(silver, "rows", F.when(F.count("*") < least, 1).otherwise(0)), _row(silver, "origin_columns", F.when(F.count("*") >= 0, 0 if origin else 1))]
    return _all(rows + [_row(silver, f"{c}_origin", F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != source))) for c in origin])


def preview(tables: dict[str, DataFrame], rows: int = 5) -> DataFrame:
    """The first rows of each table as JSON, for a look at them (a report: the limit is its feature)."""
    return _all([df.limit(rows).select(F.lit(name).alias("table"), F.to_json(F.struct(*(F.col(c) for c in df.columns))).alias("row")) for name, df in tables.items()])


def require(found: DataFrame) -> None:
    """Raises if any check has violations, naming them. Only broken checks come to the driver."""
    broken = found.filter("violations > 0").orderBy("check").collect()
    if broken:
        raise ValueError("checks failed: " + ", ".join(f"{r.check} ({r.violations})" for r in broken))
