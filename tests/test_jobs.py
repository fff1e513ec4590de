"""Whole jobs over written tables, their checks, exports, and the small functions around runs."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.functions import extract, text
from tideline.operators import crawl, marts, readiness, reports
from tideline.plans import gold, jobs
from tideline.sources import sinks, tables, web


@pytest.fixture(scope="module")
def listings(spark):
    rows = [("s", f"2024-01-0{d}", str(i), 1000 * i + d, "city1", f"d{i % 2}", "house") for d in (1, 2, 4) for i in range(1, d + 4)]
    return spark.createDataFrame(rows, "source string, crawl_date string, listing_id string, price_vnd long, city_norm string, district_norm string, property_type_group string")


def test_gold_and_warehouse(spark, listings, tmp_path):
    base = str(tmp_path)
    found = jobs.run(listings, base)
    assert found.filter("violations > 0").count() == 0 and {r.layer for r in found.select("layer").distinct().collect()} == {"gold", "warehouse"}
    made = jobs.read_gold(spark, f"{base}/gold")
    direct = gold.tables(listings)
    for name in gold.Run.NAMES[:-1]:
        columns = sorted(direct[name].columns)
        assert sorted(made[name].columns) == columns
        # The last tie-break is a hash of the row, so rows without ties are compared.
        assert sorted(map(repr, made[name].select(*columns).collect())) == sorted(map(repr, direct[name].select(*columns).collect())), name
    summary = json.loads((tmp_path / "gold" / "summary.json").read_text())
    assert summary["total_records"] == 16 and set(readiness.GOLD) <= set(summary["tables"])
    star = json.loads((tmp_path / "warehouse" / "warehouse_summary.json").read_text())
    assert star["table_row_counts"]["fact_listing"] == 16 and star["source_codes"] == ["unknown", "s"] and star["snapshot_dates"] == ["2024-01-01", "2024-01-02", "2024-01-04"]
    keys = [r.date_key for r in spark.read.parquet(f"{base}/warehouse/fact_listing").select("date_key").collect()]
    assert keys == sorted(keys)
    again = jobs.run(listings, base)  # a second run overwrites the first
    assert again.filter("violations > 0").count() == 0
    made = jobs.read_gold(spark, f"{base}/gold")
    manifest = jobs.publish(spark, f"{base}/warehouse", f"{base}/gold", f"{base}/bi").first()
    assert manifest.latest_snapshot_date == "2024-01-04"
    for file in (tmp_path / "bi" / "dim_date").glob("*.csv"):
        assert file.read_bytes().startswith("﻿date_key,".encode())
    broken = {**{n: spark.read.parquet(f"{base}/warehouse/{n}") for n in jobs.SORTED}}
    broken["dim_location"] = broken["dim_location"].filter("location_key <> '0000000000000000' and district_code <> 'd1'")
    broken["dim_date"] = broken["dim_date"].union(broken["dim_date"]).drop("year")
    names = {r.check: r.violations for r in readiness.warehouse_checks(broken, {"dim_date": 3}).filter("violations > 0").collect()}
    assert set(names) == {"dim_location_unknown", "fact_listing_location_key_orphans", "dim_date_columns", "dim_date_repeated", "dim_date_count"} and names["dim_date_count"] == 3
    assert readiness.grain_check(broken["fact_listing"].limit(10), made["snapshots"]).first().violations == 6
    bad = readiness.gold_checks({**made, "current_listings": made["current_listings"].limit(2), "removed_listings": made["removed_listings"].withColumn("snapshot_date", F.lit("1999-01-01"))}, made["summary"])
    assert {r.check for r in bad.filter("violations > 0").collect()} == {"current_rows_match", "removed_listings_days"} if made["removed_listings"].count() else True
    with pytest.raises(ValueError, match="current_rows_match"):
        readiness.require(bad)
    assert readiness.preview(made, 2).groupBy("table").count().filter("count > 2").isEmpty()
    none = readiness.summary_checks(made["summary"].withColumn("total_records", F.lit(0)).withColumn("duplicate_rate", F.lit(1.5)).drop("parse_success_rate"), ["daily"])
    assert {r.check: r.violations for r in none.filter("violations > 0").collect()} == {"absent_fields": 1, "absent_tables": 6, "total_records_positive": 1, "duplicate_rate_in_range": 1, "parse_success_rate_in_range": 1}
    silver = readiness.silver_checks(listings, "other", 99)
    assert {r.check: r.violations for r in silver.collect()} == {"rows": 1, "origin_columns": 0, "source_origin": 16}


def test_empty_layers_are_reported(spark, listings, tmp_path):
    with pytest.raises(ValueError, match="total_records_positive"):
        jobs.run(listings.limit(0), str(tmp_path))


def test_silver_and_reports(spark, listings, tmp_path):
    sinks.write_silver(listings, listings.select("listing_id").limit(0), listings.agg(F.count("*").alias("n")), str(tmp_path))
    assert json.loads((tmp_path / "quality_summary.json").read_text()) == {"n": 16}
    assert spark.read.option("header", True).csv(str(tmp_path / "listings_csv")).count() == 16 and (tmp_path / "errors_csv").exists()
    row = reports.report(spark.createDataFrame([("b", 2), ("a", 0)], "check string, violations long")).first()
    assert "| a | 0 | pass |\n| b | 2 | FAIL |" in row.text and json.loads(row.json)["violations"] == 2
    checks = {r.check: r.violations for r in reports.preflight(spark, [str(tmp_path)], [str(tmp_path / "no.yaml")]).collect()}
    assert checks[f"writable {tmp_path}"] == 0 and checks[f"config {tmp_path / 'no.yaml'}"] == 1 and checks["python_version"] == 0
    assert reports.thresholds("full", "production") == {"min_silver_records": 100} and reports.thresholds("full", "x") == {"min_silver_records": 1}
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert reports.present(df, "a", "z", "b").columns == ["a", "b"] and df.select(reports.first_present(df, "z", "a").alias("x"), reports.first_present(df, "z").alias("y")).first() == (2, None)
    log = spark.createDataFrame([("u2", "t"), ("u1", None)], "listing_url string, title string")
    sample = reports.audit_sample(log)
    assert sample.columns == list(reports.AUDIT_COLUMNS) and [r.listing_url for r in sample.collect()] == ["u1", "u2"]


def test_explorer(spark):
    rows = [(1, "negotiable", 5, True), (2, None, None, None), (3, "vnd", 7, False), (4, "vnd", 99, True)]
    df = spark.createDataFrame(rows, "n int, price_unit string, price_vnd long, f boolean")
    pick = lambda **k: {r.n for r in marts.explored(df, **k).collect()}
    assert pick(negotiable=True) == {1} and pick(negotiable=False) == {2, 3, 4} and pick(price_range=(5, 7)) == {1, 2, 3}
    assert pick(flags={"f": True}) == {1, 4} and pick(flags={"f": False}) == {2, 3} and pick(among={"n": [1, 9]}) == {1}


def test_lines_are_tried_in_order(spark):
    texts = ["Mức giá 7 tỷ\nKhoảng giá\n9 tỷ", "Khoảng giá\nkhông rõ\n9 tỷ\nMức giá 7 tỷ", "Khoảng giá\na\nb\nc\nd\n9 tỷ\nMức giá 7 tỷ", "giá bán 3 tỷ", "Diện tích 40 m2\nDiện tích\n50 m²", "Diện tích\nx\n50 m²\nDiện tích 40 m2", None]
    df = extract.parsed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw_text string"))
    got = {r.i: (r.price_raw, r.area_raw) for r in df.collect()}
    assert [got[i][0] for i in range(4)] == ["7 tỷ", "9 tỷ", "7 tỷ", "3 tỷ"] and [got[i][1] for i in (4, 5)] == ["40 m2", "50 m²"] and got[6] == (None, None)


def test_bronze_files_meet_by_path(spark, tmp_path):
    for folder in ("text", "more", "metadata"):
        (tmp_path / folder).mkdir()
    (tmp_path / "text" / "a.txt").write_text("one")
    (tmp_path / "more" / "a.txt").write_text("two")
    for i, path in enumerate(("text/a.txt", f"{tmp_path}/more/a.txt", "text/none.txt", None)):
        (tmp_path / "metadata" / f"{i}.json").write_text(json.dumps({"n": i, "raw_text_path": path}))
    got = tables.read_bronze(spark, str(tmp_path), "n int, raw_text_path string, raw_html_path string").collect()
    assert {r.n: (r.raw_text, r.raw_html) for r in got} == {0: ("one", ""), 1: ("two", ""), 2: ("", ""), 3: ("", "")}


def test_latest_production(spark, tmp_path):
    schema = "run_id string, run_class string, status string, publish_status string, finished_at string"

    def put(name, publish="published", finished="1"):
        folder = tmp_path / f"run_id={name}"
        folder.mkdir(exist_ok=True)
        (folder / "run_summary.json").write_text(json.dumps({"run_id": name, "run_class": "production", "status": "success", "publish_status": publish, "finished_at": finished}))

    put("a", finished="5")
    put("b", finished="2")
    put("c", publish="blocked", finished="9")
    pointer = tmp_path / "latest_production.json"
    latest = lambda: [r.run_id for r in tables.latest_production(spark, str(tmp_path), schema).collect()]
    assert latest() == ["a"]
    for target, want in (("run_id=b/run_summary.json", "b"), (str(tmp_path / "run_id=b" / "run_summary.json"), "b"), ("run_id=c/run_summary.json", "a"), ("nowhere.json", "a")):
        pointer.write_text(json.dumps({"summary_path": target}))
        assert latest() == [want]


def test_logs_pages_and_cards(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"u": "a", "n": 1}\n\n  \n{"u": "b"}\n')
    assert {(r.u, r.n) for r in tables.read_log(spark, str(tmp_path / "log.jsonl"), "u string, n int").collect()} == {("a", 1), ("b", None)}
    df = spark.createDataFrame([("http://x/a", 3), ("http://x/a/", 1), ("http://x?page=2&page=5", 7)], "u string, p int")
    assert [r[0] for r in df.select(text.page_url(F.col("u"), F.col("p"))).collect()] == ["http://x/a/p3", "http://x/a/", "http://x?page=2&page=7"]
    assert [r[0] for r in spark.createDataFrame([(0.5,), (None,)], "x double").select(text.percent(F.col("x"))).collect()] == ["50.00%", "N/A"]
    card = lambda t: f'<div class="js__card-listing"><a href="/x-pr1"></a><span class="js__card-title">{t}</span></div>'
    pages = web.cards(spark.createDataFrame([(f"<html>{card('z first')}{card('a second')}</html>",)], "html string"))
    details = spark.createDataFrame([("https://batdongsan.com.vn/x-pr1", 1), ("other", 2)], "listing_url string, n int")
    got = {r.n: r.listing_card_title for r in crawl.with_card_fields(details, pages).collect()}
    assert got == {1: "z first", 2: None}
    assert [r[0] for r in spark.createDataFrame([(200,), (503,), (0,), (404,), (None,)], "s int").select(crawl.retryable(F.col("s"))).collect()] == [False, True, True, False, True]
    sinks.export_csv({"t": details.withColumn("e", F.lit(None).cast("string"))}, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "t")).columns == ["listing_url", "n", "e"]
