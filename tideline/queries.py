"""Queries by name over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import extract, features, price, records, text
from .functions.keys import identity
from .operators import checks, crawl, marts, readiness, reports
from .operators import daily as d
from .plans import gold, jobs, warehouse
from .schema import typed
from .sources import web
from .sources.adapters import listings_from_events

Query = Callable[[SparkSession, str], DataFrame]


def _gold(table: str, *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = gold.Run(listings_from_events(spark, sf_dir), "event_id")[table]
        return df.select(*columns) if columns else df

    return run


def _rounded(df: DataFrame) -> DataFrame:
    places = {"avg_price_vnd": 4, "avg_unit_price_vnd_m2": 6, "median_unit_price_vnd_m2": 6}
    return df.withColumns({c: F.round(c, n) for c, n in places.items() if c in df.columns})


def _on(table: str, make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(_gold(table)(spark, sf_dir))


def _star(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = gold.Run(listings_from_events(spark, sf_dir), "event_id")
        return make(t["snapshots"], t["data_quality"])

    return run


def warehouse_checks(snap: DataFrame, quality: DataFrame) -> DataFrame:
    """The number of violations of each check on the built tables."""
    facts = warehouse.fact_listing(snap)
    listing = warehouse.dim_listing(snap)
    found = {
        "orphan_location": checks.orphans(facts, "location_key", warehouse.dim_location(snap)),
        "orphan_listing": checks.orphans(facts, "listing_key", listing),
        "orphan_property_type": checks.orphans(facts, "property_type_key", warehouse.dim_property_type(snap)),
        "orphan_date": checks.orphans(facts, "date_key", warehouse.dim_date(snap.select("snapshot_date"), quality.select("crawl_date"))),
        "repeated_listing": checks.repeated(listing, "listing_key"),
        "repeated_fact": checks.repeated(facts, "date_key", "source_key", "listing_key"),
    }
    out = None
    for name, df in found.items():
        row = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def explorer(df: DataFrame) -> DataFrame:
    kept = marts.explored(df, {"property_type_group": ["house", "land"]}, negotiable=False, price_range=(1000, 200000))
    return kept.select("dedup_key", "price_vnd", "price_unit")


def _star_tables(spark: SparkSession, sf_dir: str) -> tuple[gold.Run, dict[str, DataFrame]]:
    run = gold.Run(listings_from_events(spark, sf_dir), "event_id")
    return run, jobs.star_tables(run["snapshots"], run["data_quality"])


def star_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, tables = _star_tables(spark, sf_dir)
    row = jobs.star_summary(tables, run["snapshots"], run["data_quality"])
    days = F.size("snapshot_dates").cast("bigint").alias("days")
    return row.select(F.explode("table_row_counts").alias("table", "n"), days, F.array_join("source_codes", ",").alias("codes"))


def star_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, tables = _star_tables(spark, sf_dir)
    return readiness.warehouse_checks(tables).unionByName(readiness.grain_check(tables["fact_listing"], run["snapshots"]))


def gold_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = gold.Run(listings_from_events(spark, sf_dir), "event_id")
    tables = {name: run[name] for name in readiness.GOLD}
    return readiness.summary_checks(run["summary"], list(tables)).unionByName(readiness.gold_checks(tables, run["summary"]))


def silver_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readiness.silver_checks(listings_from_events(spark, sf_dir), "src0", 10)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs made of orders."""
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        k.cast("string").alias("run_id"), F.col("o_orderdate").cast("date").cast("string").alias("run_date"), F.when(k % 3 == 0, "smoke").when(k % 3 == 1, "full").otherwise("reparse").alias("pipeline_mode"),
        F.when(k % 7 == 0, "failed").otherwise("success").alias("pipeline_status"), F.when(k % 5 == 0, "fail").otherwise("passed").alias("validation_status"), (k % 300).alias("total_silver_records"),
        F.when(k % 11 == 0, "lost").alias("error_message"), F.when(k % 4 == 0, F.array(F.lit("a"), F.lit("b"))).when(k % 4 == 1, F.array(F.lit("a"))).alias("source_names"),
        F.when(k % 2 == 0, F.array(F.lit("2024-01-01"), F.lit("2024-01-02"))).alias("snapshot_dates"), F.when(k % 6 == 0, k % 50).alias("silver_quarantine_count"), ((k % 100) / 100).alias("parse_success_rate"),
    )


def run_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_summary(_runs(spark, sf_dir)).select("run_id", "run_class", "pipeline_status", "publish_status", "publish_block_reason", "silver_records_written", "duplicate_rate", F.size("source_names").alias("sources"))


def daily_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_summary(_runs(spark, sf_dir)).select("run_id", "pipeline_status", "error_message", "total_silver_records", "duration_seconds", F.size("snapshot_dates").alias("days"))


def snapshot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.snapshot_days(_runs(spark, sf_dir).withColumn("run_date", F.col("run_id")))


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("run_id"), F.col("l_linenumber").alias("records"))
    runs = reports.run_summary(_runs(spark, sf_dir))
    return reports.source_rows(runs, lines).select("source_code", "run_id", "publish_status", "silver_quarantine_count", "parse_success_rate")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources made of nations, with configuration, scorecard and warehouse."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    flags = F.create_map(*(x for i, n in enumerate(reports.REVIEW) for x in (F.lit(n), k % (i + 6) != 0)), F.lit("prohibited_login_required"), k % 13 == 5)
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.struct(name.alias("source_code"), (k % 8 != 1).alias("is_active"), (k % 9 != 1).alias("production_enabled"), F.lit("silver_only").alias("production_scope"), flags.alias("review"), F.lit(5).alias("min_expected_records")).alias("config"),
        F.struct(F.when(k % 10 != 3, name).otherwise("other").alias("source_code"), F.when(k % 4 != 2, "pass").otherwise("fail").alias("gate_status"), k.alias("total_records")).alias("scorecard"),
        F.when(k % 5 != 4, F.struct(F.array(name).alias("source_codes"), k.alias("listing_rows"), F.lit(1).alias("quality_rows"))).alias("warehouse"),
    )


def promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.promotion(_sources(spark, sf_dir)).select("source_code", "status", F.size("block_reasons").alias("reasons"))


def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sources(spark, sf_dir)
    return reports.acceptance(rows, F.col("config.source_code")).select("source_code", "technical_readiness_status", "source_acceptance_status", "warehouse_source_present")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl's log made of events."""
    u, i = F.col("user_id"), F.col("event_id")
    status = F.when(i % 9 == 0, 403).when(i % 9 == 1, 429).when(i % 9 == 2, 500).when(i % 9 != 3, 200)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", (u % 10).alias("part"), status.alias("status"), F.when(i % 9 == 3, F.when(i % 2 == 0, "Read timed out").otherwise("refused")).alias("error_message"),
        crawl.block_reason(status, F.when(i % 5 == 0, "<TITLE>Just a moment</title>").when(i % 7 == 0, "x h-captcha").otherwise("page"), i % 3).alias("block_reason"),
        F.concat(F.lit("u"), (u % 40).cast("string")).alias("listing_url"), (i % 1000).alias("html_bytes"), (i % 4 == 0).alias("audit_passed"),
    )


def block_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return log.select("event_id", "block_reason", reports.block_message(F.col("block_reason")).alias("message"), reports.failure_class(F.col("status"), F.col("error_message")).alias("class"), crawl.retryable(F.col("status")).alias("again"))


def crawl_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    counts = reports.http_counters(log, "part")
    return crawl.crawl_summary(log, "part").withColumns({c: F.round(c, 9) for c in ("avg_html_bytes", "success_rate", "block_rate", "audit_pass_rate")}).join(counts, "part")


def _page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of pages made of an order's key: labels and values in fixed places."""
    k = F.col("o_orderkey")
    n = (k % 90 + 1).cast("string")
    lines = F.array(
        F.lit("Mức giá"), F.when(k % 2 == 0, F.concat(n, F.lit(",5 tỷ"))).otherwise("xem sau"), F.when(k % 4 == 1, F.concat(F.lit("Khoảng giá "), n, F.lit(" triệu"))).otherwise("-"),
        F.concat(F.lit("Diện tích "), n, F.lit(" m2")), F.when(k % 3 == 0, "Địa chỉ: Phố Huế, Hà Nội").otherwise("-"), F.concat(F.lit("Nhà có "), (k % 5).cast("string"), F.lit(" phòng ngủ và "), (k % 3).cast("string"), F.lit(" toilet")),
        F.when(k % 6 == 0, "Ngày đăng: 01/02/2024").otherwise("-"), F.concat(F.lit("Tin rao bán số "), k.cast("string"), F.lit(" rất đẹp")),
    )
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        k.cast("string").alias("listing_id"), F.when(k % 5 == 0, "NhaTot").otherwise("other").alias("source"), F.array_join(lines, "\n").alias("raw_text"), F.when(k % 7 == 0, "ha-noi").alias("crawl_city"),
        F.when(k % 8 == 0, "Quận 1").alias("crawl_district"), F.lit("ban-dat").alias("crawl_category"), F.concat(n, F.lit(" tỷ")).alias("listing_card_price_raw"), F.concat(n, F.lit(" m²")).alias("listing_card_area_raw"),
        F.concat(F.lit("Ad "), k.cast("string")).alias("listing_card_title"),
    )


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _page_text(spark, sf_dir)
    kept = ("title_raw", "price_raw", "area_raw", "location_raw", "location_parse_method", "location_confidence", "city_norm", "district_norm", "posted_date_raw", "bedroom_count", "bathroom_count", "price_unit", "price_vnd", "area_m2")
    return extract.parsed(rows).select("listing_id", *kept)


def silver_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = records.records(_page_text(spark, sf_dir))
    return out.select("listing_id", "source", "source_code", "dedup_key", "dedup_method", "title_raw", "price_unit", "price_vnd", "area_m2", "property_type_raw", "property_type_group", "location_parse_method", "parse_status", "parser_version", F.lit(len(out.columns)).alias("fields"))


def features_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that features_text doesn't show, of texts that are made of an order's key."""
    k = F.col("o_orderkey")
    say = lambda n, *texts: F.coalesce(*(F.when(k % n == i, f" {t}") for i, t in enumerate(texts)), F.lit(""))
    words = F.concat(
        F.lit("Tin."), say(3, "Sổ hồng riêng.", "Đang tranh chấp."), say(4, "Chính chủ cần nhượng.", "Qua môi giới."), say(5, "Full nội thất.", "Nội thất cơ bản.", "Bàn giao thô.", "Có điều hòa."),
        F.when(k % 2 == 0, F.concat(F.lit(" "), (k % 6 + 1).cast("string"), F.lit(" phòng tắm."))).otherwise(""), say(7, "Dự án Sao Mai."), say(8, "Tiện kinh doanh."), say(9, "Gần city."),
        say(10, "Giữa khu dân cư."), say(11, "Có camera."), say(12, "Hàng xóm văn minh."), say(13, "Đất phân lô."), say(14, "Tòa S1, mới."),
    )
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", words.alias("title_raw"), F.lit("house").alias("property_type_group"))
    kept = ("has_legal_info", "legal_status_raw", "has_red_pink_book", "seller_type", "furniture_level", "bathroom_count", "project_name", "is_business_suitable", "has_urban_area_flag", "has_security_flag", "has_educated_community_flag", "has_high_intellect_flag", "has_residential_area_flag", "has_subdivision_flag", "has_car_access", "building_name")
    return features.with_features(rows, ("title_raw",)).select("o_orderkey", *kept)


def place_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of place of pages made of nations."""
    k = F.col("n_nationkey")
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        "n_nationkey", F.when(k % 4 == 0, "Phố Huế, Hai Bà Trưng").when(k % 4 == 1, "Quận Đống Đa").alias("detail_address_raw"), F.when(k % 3 == 0, "Hai Bà Trưng, Hà Nội").alias("listing_card_location_raw"),
        F.lit("https://x.test/ban-dat-hai-ba-trung/1").alias("listing_url"), (k % 2 == 0).alias("is_seed_url_valid"),
    )
    found = crawl.place_evidence(rows, F.lit("Hai Bà Trưng"), F.lit("hai-ba-trung"), F.when(k % 5 == 0, "hai-ba-trung").otherwise("nowhere"), ("Đống Đa",))
    line = reports.detail_line(F.concat(F.lit("Một dòng\n  "), F.coalesce("detail_address_raw", F.lit("-")), F.lit("  \nhết")), F.lit("Hai Bà Trưng"), F.lit("hai-ba-trung"))
    seed = crawl.valid_seed(F.lit("https://x.test/ban-dat-hai-ba-trung"), F.concat(F.lit("https://x.test/ban-dat-"), F.when(k % 2 == 0, "hai-ba-trung/").otherwise("dong-da")), F.lit("hai-ba-trung"))
    kind = crawl.category_matches(F.when(k % 2 == 0, "Bán căn hộ đẹp").otherwise("Bán nhà riêng"), F.when(k % 3 == 0, "ban-nha-rieng").otherwise("ban-can-ho-chung-cu"))
    by_text = crawl.place_of_text(F.col("detail_address_raw"), F.lit("Hai Bà Trưng"), F.lit("hai-ba-trung"), F.col("is_seed_url_valid"), ("Đống Đa",))
    return rows.select("n_nationkey", found["evidence_source"].alias("source"), found["match_status"].alias("status"), found["match_method"].alias("method"), line.alias("line"), seed.alias("seed_ok"), kind.alias("kind_ok"), by_text["status"].alias("text_status"), by_text["method"].alias("text_method"))


def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    number = F.concat((key % 97).cast("string"), F.when(key % 2 == 0, ",5").otherwise(".25"))
    raw = F.when(key % 5 == 0, F.concat(number, F.lit(" tỷ"))).when(key % 5 == 1, F.concat(number, F.lit(" Triệu"))).when(key % 5 == 2, F.concat(number, F.lit(" triệu/m²"))).when(key % 5 == 3, F.concat(number, F.lit(" VND"))).otherwise(F.concat(number, F.lit(" · Thỏa thuận")))
    p = price.price(raw)
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", p.alias("p")).select("o_orderkey", "p.value", "p.unit", "p.vnd")


def property_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*map(F.lit, ("Can-Ho chung-cu", "nha-rieng", "Bán đất", "biet-thu lien-ke", "Mặt phố", "kho")))
    category = F.element_at(words, (F.col("p_partkey") % 6 + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", price.property_type(category, F.col("p_name")).alias("kind"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.md5(F.coalesce(text.clean_text(F.col("text")), F.lit(""))).alias("cleaned"))


def slug_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.hash_key(F.col("p_name"), F.lit(None)).alias("key"))


def url_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.lit("s").alias("source"), F.col("url").alias("listing_url"))
    key = typed(pages).withColumns(identity())
    return key.select("page_id", F.regexp_replace("dedup_key", "^s::", "").alias("url"))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = spark.read.parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"))
    b = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_regionkey").cast("long").alias("region"), F.col("n_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


def large_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(marts.median("l_extendedprice").alias("median_price"), F.count("*").alias("n"))


def features_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of texts that are made of an order's key: numbers and words in fixed places."""
    key = F.col("o_orderkey")
    floors, rooms = (key % 60).cast("string"), (key % 4 + 1).cast("string")
    words = F.concat(F.lit("Nhà "), floors, F.lit(" tầng, mặt tiền "), rooms, F.lit(",5 m, "), rooms, F.lit(" phòng ngủ, hướng "), F.when(key % 2 == 0, "Đông Nam").otherwise("tây"), F.when(key % 3 == 0, ", không có thương lượng").when(key % 3 == 1, ", thương lượng").otherwise(""), F.when(key % 5 == 0, ", ô tô vào").otherwise(""))
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", words.alias("title_raw"), F.when(key % 7 == 0, "apartment").otherwise("house").alias("property_type_group"))
    out = features.with_features(df, ("title_raw",))
    return out.select("o_orderkey", "floor_count", "frontage_width", "bedroom_count", "direction", "is_price_negotiable", "car_access_type")


def json_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    ad = F.struct(F.col("n_nationkey").alias("ad_id"), (F.col("n_nationkey") + 100).alias("list_id"), F.col("n_name").alias("subject"), (F.col("n_nationkey") * 1000).alias("price"), F.lit("Ha Noi").alias("region_name"), F.lit("Đống Đa").alias("area_name"))
    nobody = F.struct(F.lit(None).cast(nation.schema["n_nationkey"].dataType).alias("ad_id"), F.lit(None).cast("bigint").alias("list_id"), F.lit("none").alias("subject"), F.lit(None).cast("bigint").alias("price"), F.lit("x").alias("region_name"), F.lit("y").alias("area_name"))
    payload = F.to_json(F.struct(F.array(ad, nobody).alias("ads")))
    return web.ads(nation.select(payload.alias("payload"))).select("listing_id", "listing_url", "listing_card_title", "price_vnd")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", web.html_text(F.col("html")).alias("text"))


def removed_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = gold.Run(listings_from_events(spark, sf_dir), "event_id")
    return d.removed(run["daily"], per_source=True, captures=run.keyed).select("dedup_key", "snapshot_date", "last_seen_before_removed")


QUERIES: dict[str, Query] = {
    "dedup_key": _gold("flagged", "event_id", "dedup_key", "dedup_method"),
    "duplicate_flags": _gold("flagged", "event_id", "duplicate_group_size", "is_duplicate_in_snapshot"),
    "daily_dedup": _gold("daily", "crawl_date", "dedup_key", "event_id", "quality_score"),
    "lifecycle": _on("daily", d.lifecycle),
    "price_changes": _gold("snapshots", "dedup_key", "snapshot_date", "snapshot_status", "is_new_listing", "price_vnd", "previous_price_vnd", "price_change_vnd", "price_change_pct", "is_price_changed"),
    "info_changes": _gold("snapshots", "dedup_key", "snapshot_date", *(f"previous_{c}" for c in d.TRACKED), *(f"is_{c}_changed" for c in d.TRACKED if c != "price_vnd"), "changed_fields", "is_info_changed"),
    "price_changed_rows": _on("snapshots", lambda df: reports.changed(df).select("dedup_key", "snapshot_date", "price_change_vnd")),
    "info_changed_by_date": _on("snapshots", lambda df: marts.count_by(reports.changed(df, "info"), "snapshot_date")),
    "removed_by_date": _on("removed_listings", lambda df: marts.count_by(df, "snapshot_date")),
    "captures_by_source": _on("flagged", lambda df: marts.count_by(df, "source", "crawl_date")),
    "district_counts": _on("current_listings", lambda df: marts.count_by(df, "district_norm", unknown="none")),
    "gold_checks": gold_checks,
    "silver_checks": silver_checks,
    "star_counts": star_counts,
    "star_checks": star_checks,
    "run_summaries": run_summaries,
    "daily_summaries": daily_summaries,
    "snapshot_days": snapshot_days,
    "source_rows": source_rows,
    "promotion": promotion,
    "acceptance": acceptance,
    "block_reasons": block_reasons,
    "crawl_rollup": crawl_rollup,
    "page_fields": page_fields,
    "silver_records": silver_records,
    "features_more": features_more,
    "place_evidence": place_evidence,
    "removed_listings": _gold("removed_listings", "dedup_key", "snapshot_date", "last_seen_before_removed", "event_id", "snapshot_status"),
    "current_listings": _gold("current_listings", "dedup_key", "snapshot_date", "event_id", "snapshot_status"),
    "market_by_district": _on("market_by_district", _rounded),
    "market_by_type": _on("market_by_type", _rounded),
    "data_quality_daily": _gold("data_quality"),
    "gold_summary": lambda s, p: _gold("summary")(s, p).select("total_records", "duplicate_record_count", "duplicate_rate", F.size(F.split("snapshot_dates", ",")).cast("long").alias("days")),
    "status_counts": _on("snapshots", lambda df: marts.count_by(df, "snapshot_date", "snapshot_status")),
    "dedup_methods": _on("flagged", lambda df: marts.count_by(df, "dedup_method")),
    "top_districts": _on("market_by_district", marts.top_districts),
    "top_median_districts": _on("market_by_district", marts.top_median_districts),
    "quality_long": _on("data_quality", lambda df: marts.melted(df, ["crawl_date", "source"], ["parse_success_rate", "duplicate_rate"])),
    "rolling_baseline": _on("data_quality", lambda df: marts.baseline(df, "crawl_date", ["duplicate_rate"], by=["source"]).select("crawl_date", "source", *(F.round(c, 9).alias(c) for c in ("duplicate_rate", "duplicate_rate_baseline", "duplicate_rate_delta")))),
    "source_gate": _on("data_quality", lambda df: checks.source_gate(df).select("crawl_date", "source", "gate")),
    "quality_class": _on("data_quality", lambda df: df.select("crawl_date", "source", checks.quality_class(F.col("parse_success_rate"), F.col("duplicate_rate")).alias("class"))),
    "explorer_filters": _on("current_listings", explorer),
    "dim_date": _star(lambda s, q: warehouse.dim_date(s.select("snapshot_date"), q.select("crawl_date"))),
    "dim_source": _star(warehouse.dim_source),
    "dim_property_type": _star(lambda s, q: warehouse.dim_property_type(s)),
    "dim_location": _star(lambda s, q: warehouse.dim_location(s).select("location_key", "city_code", "district_code", "ward_code", "location_level", "location_confidence")),
    "dim_listing": _star(lambda s, q: warehouse.dim_listing(s)),
    "fact_listing": _star(lambda s, q: warehouse.fact_listing(s).withColumn("unit_price_vnd_m2", F.round("unit_price_vnd_m2", 6))),
    "fact_quality": _star(lambda s, q: warehouse.fact_quality(q)),
    "warehouse_checks": _star(warehouse_checks),
    "price_parse": price_parse,
    "property_types": property_types,
    "clean_text": clean_text,
    "slug_key": slug_key,
    "url_norm": url_norm,
    "features_text": features_text,
    "json_ads": json_ads,
    "html_text": html_text,
    "duplicate_summary": _on("flagged", marts.duplicate_summary),
    "removed_per_source": removed_per_source,
    "union_by_name": union_by_name,
    "large_medians": large_medians,
}
