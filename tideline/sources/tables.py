"""Readers of the lake's layouts. Each is one dataset read with partition pruning, not a read for each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..schema import LISTING, typed, without_void


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (globs allowed) has anything, on any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def from_path(name: str, path: Column | None = None) -> Column:
    """The value of name=value in a row's file path; null without it."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path") if path is None else path, f"{name}=([^/]+)", 1), F.lit(""))


def read_listings(spark: SparkSession, base: str) -> DataFrame:
    """Canonical listings under source=/crawl_date=/crawl_id= or, only if there are none, source=/crawl_date=. Files of
    different schemas are merged by name; source, day and crawl come from the path where the files lack them."""
    deep, old = f"{base}/source=*/crawl_date=*/crawl_id=*/*.parquet", f"{base}/source=*/crawl_date=*/*.parquet"
    glob = next((g for g in (deep, old) if exists(spark, g)), None)
    if glob is None:
        raise FileNotFoundError(f"no listings under {base}")
    df = spark.read.option("mergeSchema", "true").parquet(glob)
    paths = {c: from_path(c) for c in ("source", "crawl_date", "crawl_id")}
    df = df.select(*(c for c in df.columns if c not in paths), *((F.coalesce(F.col(c).cast("string"), p) if c in df.columns else p).alias(c) for c, p in paths.items()))
    return typed(without_void(df))


def read_hive(spark: SparkSession, path: str, required: bool = True) -> DataFrame | None:
    """A partitioned table with its partition columns as strings; None if it may be absent and is. Only this read's types
    of partition columns change: they are asked for as strings, whatever the session infers."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        if required:
            raise
        return None
    own = {f.name for f in spark.read.option("recursiveFileLookup", "true").parquet(path).schema.fields}
    levels = [f.name for f in df.schema.fields if f.name not in own]
    if not levels:
        return df
    schema = StructType([StructField(f.name, StringType() if f.name in levels else f.dataType) for f in df.schema.fields])
    return spark.read.schema(schema).parquet(path)


def read_first(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """A table by the first of its forms that is there: table, its CSV sample, its CSV; Parquet before CSV."""
    for folder in (name, f"{name}_csv_sample", f"{name}_csv"):
        for kind in ("parquet", "csv"):
            if exists(spark, f"{base}/{folder}/*.{kind}") or exists(spark, f"{base}/{folder}/*/*.{kind}"):
                return spark.read.parquet(f"{base}/{folder}") if kind == "parquet" else spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{base}/{folder}")
    return None


def read_bronze(spark: SparkSession, base: str, metadata_schema: str) -> DataFrame:
    """Metadata records with the text and HTML files that they name; an absent file is ''. Files meet their record by
    path, in one join for each kind: a named path is one under base, absolute or with any part of base before it."""
    meta = spark.read.schema(metadata_schema).option("multiLine", True).json(f"{base}/metadata/*.json")
    out = meta.withColumn("metadata_path", F.col("_metadata.file_path"))
    # The last two parts of a path (kind's folder and file name) name a file under base, as files lie one level deep.
    tail = lambda x: F.regexp_extract(x, r"([^/]+/[^/]+)$", 1)
    for column, kind, name in (("raw_text_path", "txt", "raw_text"), ("raw_html_path", "html", "raw_html")):
        glob = f"{base}/*/*.{kind}"
        if not exists(spark, glob):
            out = out.withColumn(name, F.lit(""))
            continue
        files = spark.read.option("wholetext", True).text(glob).select(F.col("value").alias(name), tail(F.url_decode("_metadata.file_path")).alias("__file"))
        out = out.withColumn("__file", tail(F.coalesce(column, F.lit("")))).join(files, "__file", "left").drop("__file").withColumn(name, F.coalesce(name, F.lit("")))
    return out


def read_run_summaries(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Summaries of daily runs and of single runs, with their path; files that are no JSON are left out."""
    frames = []
    for glob in (f"{base}/run_date=*/daily_run_summary.json", f"{base}/run_id=*/run_summary.json"):
        if exists(spark, glob):
            df = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).json(glob).withColumn("summary_path", F.col("_metadata.file_path"))
            frames.append(df.filter("_corrupt_record is null").drop("_corrupt_record"))
    out = frames[0] if frames else spark.createDataFrame([], f"{schema}, summary_path string")
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def latest_published(runs: DataFrame) -> DataFrame:
    """The last run (by finished_at, then run_id) of class production that succeeded and was published."""
    return runs.filter(_published(runs)).orderBy(F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()).limit(1)


def _published(runs: DataFrame) -> Column:
    status = "status" if "status" in runs.columns else "pipeline_status"
    return (F.col("run_class") == "production") & (F.col(status) == "success") & (F.col("publish_status") == "published")


def latest_production(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """The summary that base/latest_production.json points to, if it is there, can be read and is a published production
    run; else the last of all summaries that is one. A relative path is tried under base and the three folders above."""
    pointer = f"{base}/latest_production.json"
    if exists(spark, pointer):
        row = spark.read.schema("summary_path string").option("multiLine", True).json(pointer).first()
        named = row.summary_path if row else None
        above = [base, *(base.rstrip("/") + "/.." * k for k in (1, 2, 3))]
        tried = [] if not named else [named] if "://" in named or named.startswith("/") else [f"{b}/{named}" for b in above]
        found = next((p for p in tried if exists(spark, p)), None)
        if found is not None:
            out = spark.read.schema(schema).option("multiLine", True).json(found)
            out = out.withColumn("summary_path", F.col("_metadata.file_path"))
            if not (kept := out.filter(_published(out))).isEmpty():
                return kept
    return latest_published(read_run_summaries(spark, base, schema))


def quarantine_counts(spark: SparkSession, base: str) -> DataFrame:
    """Non-blank lines of quarantine files by stage, source, date and run."""
    schema = "stage string, source string, date string, run_id string, records long"
    glob = f"{base}/*/source=*/date=*/quarantine_*.jsonl"
    if not exists(spark, glob):
        return spark.createDataFrame([], schema)
    path = F.col("_metadata.file_path")
    lines = spark.read.text(glob).filter(F.trim("value") != "")
    stage = F.regexp_extract(path, r"([^/]+)/source=[^/]+/date=[^/]+/[^/]+$", 1)
    run = F.regexp_extract(path, r"quarantine_([^/]+)\.jsonl$", 1)
    return lines.groupBy(stage.alias("stage"), from_path("source", path).alias("source"), from_path("date", path).alias("date"), run.alias("run_id")).agg(F.count("*").alias("records"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A crawl log of JSON lines; blank lines don't count."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.read.schema(schema).json(path).filter(F.coalesce(*(F.col(c).cast("string") for c in names)).isNotNull())


def source_keys(spark: SparkSession, path: str, default: dict[str, int]) -> dict[str, int]:
    """`name: number` lines of a small file (# starts a comment); the default if it is absent or has none."""
    if not exists(spark, path):
        return default
    found = {}
    for row in spark.read.text(path).collect():  # a configuration file, read whole
        name, colon, value = row.value.split("#", 1)[0].partition(":")
        name, value = name.strip().strip("\"'").lower(), value.strip().strip("\"'")
        if colon and name and value.lstrip("-").isdigit():
            found[name] = int(value)
    return found or default


__all__ = ["LISTING", "exists", "from_path", "latest_production", "latest_published", "quarantine_counts", "read_bronze", "read_first", "read_hive", "read_listings", "read_log", "read_run_summaries", "source_keys"]
