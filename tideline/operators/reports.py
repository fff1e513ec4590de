"""What is told of runs: summaries, scorecards, gates to production, acceptance, and small projections for reports."""

from __future__ import annotations

import importlib.util
import shutil
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import search_form

# Fields of run summaries, in order, with their types and defaults.
RUN_FIELDS = (
    "summary_schema_version string, run_id string, run_date string, pipeline_mode string, run_class string, pipeline_status string, validation_status string, publish_status string, "
    "publish_block_reason string, source_names array<string>, crawl_ids_created array<string>, crawl_configs array<string>, warnings array<string>, errors array<string>, artifact_paths array<string>, "
    "bronze_records_written bigint, silver_records_written bigint, silver_quarantine_count bigint, gold_snapshot_records bigint, warehouse_fact_records bigint, total_current_listings bigint, "
    "duplicate_record_count bigint, duplicate_rate double, parse_success_rate double, missing_price_rate double, missing_area_rate double, missing_location_rate double, snapshot_dates array<string>, "
    "start_time string, end_time string, duration_seconds bigint, error_message string, input_silver_partitions array<string>, published_outputs array<string>"
)
DAILY_FIELDS = (
    "summary_schema_version string, run_id string, run_date string, pipeline_mode string, pipeline_status string, validation_status string, gcs_sync_status string, error_message string, "
    "warnings array<string>, errors array<string>, artifact_paths array<string>, start_time string, end_time string, duration_seconds bigint, crawl_configs array<string>, crawl_ids_created array<string>, "
    "total_silver_records bigint, total_current_listings bigint, duplicate_record_count bigint, duplicate_rate double, parse_success_rate double, missing_price_rate double, missing_area_rate double, "
    "missing_location_rate double, snapshot_dates array<string>"
)
THRESHOLDS = {"defaults": {"min_silver_records": 1}, "modes": {"smoke": {"min_silver_records": 1}, "full": {"production": {"min_silver_records": 100}}}}
REVIEW = ("terms_reviewed", "robots_checked", "personal_contact_handling_documented", "approved_fetch_mode_documented", "no_captcha_bypass_required")
AUDIT_COLUMNS = (
    "listing_url", "source_seed_url", "final_seed_url", "is_seed_url_valid", "crawl_category", "crawl_location_label", "title", "price_raw", "area_raw", "listing_card_location_raw",
    "listing_card_old_district_raw", "detail_address_raw", "breadcrumb_location_raw", "detail_location_raw", "location_evidence_text", "location_evidence_source", "location_match_status", "category_match_status",
)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Those of the columns that df has, in the order given."""
    return df.select(*(c for c in columns if c in df.columns))


def first_present(df: DataFrame, *columns: str) -> Column:
    """The first of the columns that df has; null if it has none."""
    return next((F.col(c) for c in columns if c in df.columns), F.lit(None).cast("string"))


def changed(snap: DataFrame, what: str = "price") -> DataFrame:
    """Rows whose price (or with `info`, any tracked field) changed."""
    return snap.filter(F.col(f"is_{what}_changed").eqNullSafe(True))


def thresholds(mode: str, run_class: str, config: dict | None = None) -> dict:
    """Thresholds of a run: defaults, then the mode's, then those of the mode's class."""
    config = THRESHOLDS if config is None else config
    by_mode = config.get("modes", {}).get(mode, {})
    plain = {k: v for k, v in by_mode.items() if not isinstance(v, dict)}
    return {**config.get("defaults", {}), **plain, **by_mode.get(run_class, {})}


def _shaped(df: DataFrame, fields: str) -> DataFrame:
    """df with the fields in order: text as it is, numbers as such (0 if absent or not a number), lists never null (one
    value becomes a list)."""
    types, out = dict(df.dtypes), []
    for field in fields.split(", "):
        name, kind = field.split(" ", 1)
        if name not in types:
            value = F.lit(None)
        elif kind.startswith("array") and not types[name].startswith("array"):
            value = F.when(F.col(name).isNotNull() & (F.col(name).cast("string") != ""), F.array(F.col(name).cast("string")))
        else:
            value = F.col(name)
        if kind.startswith("array"):
            value = F.coalesce(value.cast(kind), F.array().cast(kind))
        elif kind in ("bigint", "double"):
            value = F.coalesce(value.try_cast("double").cast(kind) if name in types else value.cast(kind), F.lit(0).cast(kind))
        out.append(value.cast(kind).alias(name))
    return df.select(*out)


def run_class(mode: Column) -> Column:
    """The class of a run that doesn't say, by its mode."""
    return F.when(mode == "full", "production").when(mode == "smoke", "smoke").when(mode.isin("backfill", "reparse"), "manual").otherwise("test")


def run_summary(runs: DataFrame, least: dict | None = None) -> DataFrame:
    """Production summaries of runs (any of RUN_FIELDS and total_silver_records): an error or a failed status is failed, an
    absent class follows the mode, absent records written are the total, and an absent publish status follows from
    status, validation and records against the thresholds."""
    has = lambda c, kind="string": F.col(c) if c in runs.columns else F.lit(None).cast(kind)
    mode = F.coalesce(has("pipeline_mode"), F.lit("full"))
    status = F.when((has("pipeline_status") == "failed") | (F.coalesce(has("error_message"), F.lit("")) != ""), "failed").otherwise(has("pipeline_status"))
    kind = F.coalesce(has("run_class"), run_class(mode))
    records = F.coalesce(has("silver_records_written", "bigint").cast("bigint"), has("total_silver_records", "bigint").cast("bigint"), F.lit(0))
    known = [(m, k) for m, v in (least or THRESHOLDS)["modes"].items() for k in (x for x in v if isinstance(v[x], dict))]
    minimum = F.lit(thresholds("", "", least).get("min_silver_records", 1))
    for m, k in known:
        minimum = F.when((mode == m) & (kind == k), thresholds(m, k, least)["min_silver_records"]).otherwise(minimum)
    valid = F.coalesce(has("validation_status"), F.lit(""))
    pair = lambda a, b: F.struct(F.lit(a).alias("status"), (b if isinstance(b, Column) else F.lit(b).cast("string")).alias("reason"))
    decided = (
        F.when((kind != "production") | (mode != "full"), pair("skipped", None))
        .when(~status.eqNullSafe("success"), pair("blocked", F.concat(F.lit("pipeline_status="), F.coalesce(status, F.lit("null")))))
        .when(~valid.isin("pass", "passed"), pair("blocked", F.concat(F.lit("validation_status="), valid)))
        .when(records <= 0, pair("blocked", "no records"))
        .when(records < minimum, pair("blocked", F.concat(F.lit("records "), records.cast("string"), F.lit(" below minimum "), minimum.cast("string"))))
        .otherwise(pair("published", None))
    )
    out = runs.withColumns({"__d": decided, "pipeline_mode": mode, "pipeline_status": status, "run_class": kind, "silver_records_written": records})
    told = has("publish_status").isNotNull()
    out = out.withColumn("publish_block_reason", F.when(told, has("publish_block_reason")).otherwise(F.coalesce(has("publish_block_reason"), F.col("__d.reason"))))
    out = out.withColumn("publish_status", F.coalesce(has("publish_status"), F.col("__d.status"))).withColumn("summary_schema_version", F.lit("v2"))
    return _shaped(out, RUN_FIELDS)


def daily_summary(runs: DataFrame) -> DataFrame:
    """Daily summaries: an error is a failed run, a failed run without a message gets one."""
    has = lambda c: F.col(c) if c in runs.columns else F.lit(None).cast("string")
    message = F.nullif(has("error_message"), F.lit(""))
    status = F.when((has("pipeline_status") == "failed") | message.isNotNull(), "failed").otherwise(has("pipeline_status"))
    message = F.when(status == "failed", F.coalesce(message, F.lit("Pipeline failed"))).otherwise(message)
    out = runs.withColumns({"pipeline_status": status, "error_message": message, "summary_schema_version": F.lit("v1"), "pipeline_mode": F.coalesce(has("pipeline_mode"), F.lit("full"))})
    return _shaped(out, DAILY_FIELDS)


def snapshot_days(runs: DataFrame) -> DataFrame:
    """One row for each snapshot date of each run: run_date, snapshot_date, total_silver_records."""
    return runs.select("run_date", F.explode("snapshot_dates").alias("snapshot_date"), "total_silver_records")


def with_quarantine(runs: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Runs with the number of their quarantined records (run_id, records): the run's own if it isn't 0, else the files'."""
    counted = quarantine.filter("run_id is not null").groupBy("run_id").agg(F.sum(F.col("records").try_cast("bigint")).alias("__quarantined"))
    own = F.col("silver_quarantine_count") if "silver_quarantine_count" in runs.columns else F.lit(None).cast("bigint")
    out = runs.join(counted, "run_id", "left").withColumn("silver_quarantine_count", F.coalesce(F.nullif(own, F.lit(0)), "__quarantined", F.lit(0)).cast("bigint"))
    return out.drop("__quarantined").select(*runs.columns, *(["silver_quarantine_count"] if "silver_quarantine_count" not in runs.columns else []))


def source_rows(runs: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row for each source of each run with the run's measures."""
    names = F.col("source_names") if dict(runs.dtypes)["source_names"].startswith("array") else F.when(F.col("source_names") != "", F.array("source_names"))
    out = with_quarantine(runs, quarantine).withColumn("source_code", F.explode(names))
    return out.select("source_code", "run_id", "run_date", "publish_status", "silver_records_written", "silver_quarantine_count", "parse_success_rate", "missing_price_rate")


def promotion(sources: DataFrame, review: tuple[str, ...] = REVIEW) -> DataFrame:
    """Whether sources may go to production: source_code, status (`pass` or `blocked`) and block_reasons. sources has a row
    for each with struct columns config (source_code, is_active, production_enabled, production_scope, review (map of
    flags), min_expected_records), scorecard (source_code, gate_status, total_records) and, null where there is none yet,
    warehouse (source_codes, listing_rows, quality_rows)."""
    c, own = F.col, F.coalesce(F.col("config.source_code"), F.lit(""))
    other = F.coalesce(c("scorecard.source_code"), F.lit(""))
    true = lambda x: x.eqNullSafe(F.lit(True))
    flag = lambda n: F.try_element_at(c("config.review"), F.lit(n))
    there = c("warehouse").isNotNull()
    tests = [
        (own == "", F.lit("the configuration has no source_code")),
        ((own != "") & (other != "") & (own != other), F.concat(F.lit("the scorecard is of "), other)),
        (~true(c("config.is_active")), F.lit("the source is not active")),
        (~true(c("config.production_enabled")), F.lit("production is not enabled")),
        *((~true(flag(n)), F.lit(f"{n} is not true")) for n in review),
        (true(flag("prohibited_login_required")), F.lit("a prohibited login is required")),
        (~c("scorecard.gate_status").eqNullSafe("pass"), F.lit("the scorecard's gate is not passed")),
        (F.coalesce(c("scorecard.total_records"), F.lit(0)) < F.coalesce(c("config.min_expected_records"), F.lit(0)), F.lit("fewer records than expected")),
        (there & (own != "") & ~F.coalesce(F.array_contains(c("warehouse.source_codes"), own), F.lit(False)), F.lit("the warehouse lacks the source")),
        (there & (F.coalesce(c("warehouse.listing_rows"), F.lit(0)) <= 0), F.lit("the warehouse has no listing facts")),
        (there & (F.coalesce(c("warehouse.quality_rows"), F.lit(0)) <= 0), F.lit("the warehouse has no quality facts")),
    ]
    out = sources.withColumn("block_reasons", F.array_compact(F.array(*(F.when(bad, text) for bad, text in tests))))
    return out.select(own.alias("source_code"), F.when(F.size("block_reasons") == 0, "pass").otherwise("blocked").alias("status"), "block_reasons")


def acceptance(sources: DataFrame, source: Column) -> DataFrame:
    """The evidence for sources (rows as for `promotion`): eight items, of which the first seven are technical, and the
    verdicts on them."""
    c = F.col
    items = {
        "source_config_exists": c("config.source_code") == source,
        "source_lineage_preserved": c("scorecard.source_code") == source,
        "source_scorecard_passed": c("scorecard.gate_status") == "pass",
        "silver_records_present": c("scorecard.total_records") > 0,
        "warehouse_source_present": F.array_contains(c("warehouse.source_codes"), source),
        "warehouse_snapshot_fact_present": c("warehouse.listing_rows") > 0,
        "warehouse_quality_fact_present": c("warehouse.quality_rows") > 0,
        "production_scope_is_silver_only": c("config.production_scope") == "silver_only",
    }
    decided = promotion(sources)
    judged = sources.withColumn("source_code", source).withColumns({k: F.coalesce(v, F.lit(False)) for k, v in items.items()})
    ready = F.forall(F.array(*list(items)[:7]), lambda x: x)
    judged = judged.withColumn("technical_readiness_status", F.when(ready, "pass").otherwise("fail"))
    out = judged.join(decided.select("source_code", F.col("status").alias("promotion_status"), F.col("block_reasons").alias("promotion_block_reasons")), "source_code", "left")
    both = (F.col("technical_readiness_status") == "pass") & (F.col("promotion_status") == "pass")
    return out.select("source_code", "technical_readiness_status", "promotion_status", F.when(both, "pass").otherwise("blocked").alias("source_acceptance_status"), *items, "promotion_block_reasons")


def report(found: DataFrame, title: str = "Checks") -> DataFrame:
    """A report of checks (check, violations) in Markdown, one row `text`; also as JSON, `json`."""
    line = F.concat(F.lit("| "), F.col("check"), F.lit(" | "), F.col("violations").cast("string"), F.lit(" | "), F.when(F.col("violations") == 0, "pass").otherwise("FAIL"), F.lit(" |"))
    rows = F.array_sort(F.collect_list(F.struct(F.col("check"), "violations", line.alias("line"))))
    out = found.agg(rows.alias("rows"), F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))
    head = F.concat(F.lit(f"# {title}\n\n"), F.when(F.col("violations") == 0, "All checks passed.").otherwise(F.concat(F.col("violations").cast("string"), F.lit(" violations."))), F.lit("\n\n| check | violations | result |\n|-|-|-|\n"))
    plain = F.transform("rows", lambda r: F.struct(r["check"].alias("check"), r["violations"].alias("violations")))
    return out.select(F.concat(head, F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("\n")).alias("text"), F.to_json(F.struct("violations", plain.alias("checks"))).alias("json"))


def preflight(spark: SparkSession, paths: list[str] = (), configs: list[str] = (), modules: tuple[str, ...] = ("pyspark", "pyarrow", "pandas")) -> DataFrame:
    """Checks of the place before a run (check, violations): the interpreter, modules, Java, folders that can be written,
    configuration files that are there, on any file system that Spark knows."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def writable(path: str) -> bool:
        probe = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/.preflight")
        try:
            system = probe.getFileSystem(conf)
            system.create(probe, True).close()
            return system.delete(probe, False)
        except Exception:  # noqa: BLE001 - any failure means that it can't be written
            return False

    def there(path: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    rows = [("python_version", sys.version_info >= (3, 11)), ("java_runtime", shutil.which("java") is not None or spark.sparkContext is not None)]
    rows += [(f"module_{m}", importlib.util.find_spec(m) is not None) for m in modules]
    rows += [(f"writable {p}", writable(p)) for p in paths] + [(f"config {p}", there(p)) for p in configs]
    return spark.createDataFrame([(name, 0 if ok else 1) for name, ok in rows], "check string, violations long")


def detail_line(text: Column, label: Column, slug: Column) -> Column:
    """The first line of a text that names a place by its label or slug, trimmed; null without one."""
    terms = F.filter(F.array(search_form(label, symbols=False), F.lower(F.replace(F.coalesce(slug, F.lit("")), F.lit("-"), F.lit(" ")))), lambda t: t != "")
    lines = F.split(F.coalesce(text, F.lit("")), r"\R")
    hits = F.filter(lines, lambda x: F.exists(terms, lambda t: F.contains(search_form(x, symbols=False), t)))
    return F.trim(F.regexp_replace(F.try_element_at(hits, F.lit(1)), r"(?U)^\s+|\s+$", ""))


def failure_class(status: Column, message: Column) -> Column:
    """The class of a failed request."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.when(status.isin(403, 429), "blocked").when(status.isNotNull(), "failed_http").when(low.contains("timeout") | low.contains("timed out"), "failed_timeout").otherwise("failed_fetch")


def block_message(reason: Column) -> Column:
    """What is told of a block; null without a reason."""
    named = F.when(reason == "cloudflare_turnstile", "Cloudflare Turnstile anti-bot").when(reason == "cloudflare_challenge", "Cloudflare anti-bot").when(reason == "captcha", "CAPTCHA anti-bot").otherwise("anti-bot")
    return F.when(F.coalesce(reason, F.lit("")) != "", F.concat(F.lit("Blocked by "), named, F.lit(" protection")))


def http_counters(log: DataFrame, *by: str) -> DataFrame:
    """Answers 403 and 429 of a crawl's log, and failures by class."""
    kind = failure_class(F.col("status"), F.col("error_message")) if "error_message" in log.columns else failure_class(F.col("status"), F.lit(None))
    bad = ~F.coalesce(F.col("status").between(200, 299), F.lit(False))
    counts = [F.count_if(bad & (kind == k)).alias(f"{k}_count") for k in ("blocked", "failed_http", "failed_timeout", "failed_fetch")]
    return log.groupBy(*by).agg(F.count_if(F.col("status") == 403).alias("http_403_count"), F.count_if(F.col("status") == 429).alias("http_429_count"), *counts)


def audit_sample(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows (by listing_url; the limit is the sample's feature) in the audit's fixed columns, absent ones null."""
    return df.select(*((F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in AUDIT_COLUMNS)).orderBy("listing_url").limit(rows)
