"""Writers: partitioned tables, samples, summaries, quarantine, exports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import without_void

#: Fields that every quarantined record must have.
QUARANTINE = ("stage", "source", "date", "run_id", "reason")


def write_table(df: DataFrame, path: str, by: Iterable[str] = (), whole: bool = False) -> None:
    """Overwrites a Parquet table; with partition columns only the partitions that df has, or with `whole` all. Rows of a partition go to one
    task by hash first, spread over a few by the size that the adaptive planner sees, so files stay few and large."""
    df, by = without_void(df), list(by)
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_sample(df: DataFrame, path: str, order: Iterable[str], rows: int = 1000) -> None:
    """The first rows in an order, as one CSV file with a header."""
    without_void(df).orderBy(*order).limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_gold(tables: dict[str, DataFrame], base: str, partitions: dict[str, str], order: dict[str, list[str]]) -> None:
    """Tables under base, each partitioned by the column named for it, with a CSV sample beside it."""
    for name, df in tables.items():
        write_table(df, f"{base}/{name}", [partitions[name]] if name in partitions else [])
        if name in order:
            write_sample(df.sparkSession.read.parquet(f"{base}/{name}"), f"{base}/{name}_csv_sample", order[name])


def write_json(spark: SparkSession, text: str, path: str) -> None:
    """A small file, written under another name and renamed, on any file system."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"could not rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, on any file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row frame as a JSON file."""
    write_json(summary.sparkSession, summary.select(F.to_json(F.struct(*summary.columns))).first()[0], path)


def append_quarantine(df: DataFrame, base: str) -> None:
    """Appends records as JSON lines by stage, source and date; a record that lacks a required field stops the write."""
    missing = [c for c in QUARANTINE if c not in df.columns]
    if missing:
        raise ValueError(f"quarantined records need {', '.join(missing)}")
    bad = F.lit(False)
    for c in QUARANTINE:
        bad = bad | F.col(c).isNull()
    checked = df.withColumn("reason", F.when(bad, F.raise_error("a quarantined record lacks a required field")).otherwise(F.col("reason")))
    checked.write.mode("append").partitionBy("stage", "source", "date").json(base)


def _marked(df: DataFrame) -> DataFrame:
    """df whose first column's name starts with a byte order mark, so that each CSV file with a header does."""
    return df.withColumnRenamed(df.columns[0], f"\ufeff{df.columns[0]}")


def write_silver(listings: DataFrame, errors: DataFrame, summary: DataFrame, base: str) -> None:
    """Parsed listings as Parquet and, if there are any, as CSV with a byte order mark; errors as such CSV always; the
    one-row quality summary as JSON."""
    write_table(listings, f"{base}/listings")
    written = listings.sparkSession.read.parquet(f"{base}/listings")
    if not written.isEmpty():
        export_csv({"listings_csv": written}, base, bom=True)
    export_csv({"errors_csv": errors}, base, bom=True)
    write_summary(summary, f"{base}/quality_summary.json")


def export_csv(tables: dict[str, DataFrame], base: str, bom: bool = False) -> None:
    """Each table as CSV with nulls as nothing, for other tools; with bom each file starts with a byte order mark."""
    for name, df in tables.items():
        df = _marked(df) if bom else df
        without_void(df).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(f"{base}/{name}")


def export_manifest(spark: SparkSession, tables: dict[str, DataFrame], dates: DataFrame, path: str) -> DataFrame:
    """One row: the latest date and the tables' row counts, also written as JSON."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n") for name, df in tables.items()]
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    rows = every.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n")))).alias("rows"))
    out = dates.agg(F.max(F.col(dates.columns[0]).cast("string")).alias("latest_snapshot_date")).crossJoin(rows)
    write_summary(out, path)
    return out
