"""Readers, writers, daily operators on edge cases, gates, and the stream against the batch."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tideline.functions.keys import api_key
from tideline.operators import checks, daily, marts
from tideline.plans import gold, warehouse
from tideline.schema import LISTING, typed
from tideline.sources import sinks, tables
from tideline.streaming import daily as stream


def test_listings_layouts(spark, tmp_path):
    base = str(tmp_path / "silver")
    with pytest.raises(FileNotFoundError):
        tables.read_listings(spark, base)
    spark.createDataFrame([("1", 5)], "listing_id string, price_vnd long").write.parquet(f"{base}/source=a/crawl_date=2024-01-01")
    old = tables.read_listings(spark, base).collect()
    assert [(r.source, r.crawl_date, r.crawl_id, r.price_vnd) for r in old] == [("a", "2024-01-01", None, 5)]
    spark.createDataFrame([("2", None)], "listing_id string, x int").write.parquet(f"{base}/source=b/crawl_date=2024-01-02/crawl_id=c1")
    spark.createDataFrame([("3", 7.5)], "listing_id string, area_m2 double").write.parquet(f"{base}/source=b/crawl_date=2024-01-02/crawl_id=c2")
    df = tables.read_listings(spark, base)
    assert df.columns[: len(LISTING)] == list(LISTING)
    assert sorted((r.listing_id, r.source, r.crawl_date, r.crawl_id, r.area_m2) for r in df.collect()) == [("2", "b", "2024-01-02", "c1", None), ("3", "b", "2024-01-02", "c2", 7.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "a int, day string").withColumn("v", F.lit(None))
    path = str(tmp_path / "t")
    sinks.write_table(df, path, ["day"])
    sinks.write_table(df.filter("a = 2").withColumn("a", F.lit(9)), path, ["day"])
    back = tables.read_hive(spark, path)
    assert sorted((r.a, r.day, r.v) for r in back.collect()) == [(1, "2024-01-01", None), (9, "2024-01-02", None)]
    assert tables.read_hive(spark, str(tmp_path / "none"), required=False) is None
    sinks.write_sample(df, str(tmp_path / "gold" / "x_csv_sample"), ["a"], 1)
    assert [r.a for r in tables.read_first(spark, str(tmp_path / "gold"), "x").collect()] == ["1"]
    sinks.write_summary(df.agg(F.count("*").alias("n")), str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text()) == {"n": 2}
    record = spark.createDataFrame([("parse", "a", "2024-01-01", "r1", "bad", {"k": "v"})], "stage string, source string, date string, run_id string, reason string, extra map<string,string>")
    sinks.append_quarantine(record, str(tmp_path / "q"))
    sinks.append_quarantine(record, str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).count() == 2
    with pytest.raises(ValueError):
        sinks.append_quarantine(record.drop("reason"), str(tmp_path / "q"))
    manifest = sinks.export_manifest(spark, {"t": df}, df.select("day"), str(tmp_path / "m.json")).first()
    assert (manifest.latest_snapshot_date, manifest.rows) == ("2024-01-02", {"t": 2})


def test_small_files(spark, tmp_path):
    (tmp_path / "run_id=a").mkdir()
    (tmp_path / "run_id=b").mkdir()
    (tmp_path / "run_id=a" / "run_summary.json").write_text(json.dumps({"run_id": "a", "run_class": "production", "status": "success", "publish_status": "published", "finished_at": "2024-01-02"}))
    (tmp_path / "run_id=b" / "run_summary.json").write_text("{broken")
    runs = tables.read_run_summaries(spark, str(tmp_path), "run_id string, run_class string, status string, publish_status string, finished_at string")
    assert [r.run_id for r in tables.latest_published(runs).collect()] == ["a"]
    q = tmp_path / "q" / "parse" / "source=x" / "date=2024-01-01"
    q.mkdir(parents=True)
    (q / "quarantine_r1.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert [tuple(r) for r in tables.quarantine_counts(spark, str(tmp_path / "q")).collect()] == [("parse", "x", "2024-01-01", "r1", 2)]
    (tmp_path / "keys.yaml").write_text("# c\nUnknown: 0\nsite: 7 # x\nbad: y\n")
    assert tables.source_keys(spark, str(tmp_path / "keys.yaml"), {}) == {"unknown": 0, "site": 7}
    assert tables.source_keys(spark, str(tmp_path / "no.yaml"), {"d": 1}) == {"d": 1}


def test_keys(spark):
    rows = [("s", " 7 ", None, None), (None, " ", "HTTP://X/a//?q#f", None), ("s", None, None, None), ("s", "7", None, " mine ")]
    df = spark.createDataFrame(rows, "source string, listing_id string, listing_url string, dedup_key string")
    got = [(r.dedup_key, r.dedup_method) for r in daily.keyed(df).collect()]
    assert got[0] == ("s::7", "listing_id") and got[1] == ("unknown_source::http://x/a", "listing_url") and got[3] == ("mine", "preexisting")
    assert got[2][1] == "content_hash" and len(got[2][0]) == 3 + 64
    keys = spark.createDataFrame([("1", "u"), (None, "u?x"), (" ", None)], "i string, u string").select(api_key(F.lit("n"), F.col("i"), F.col("u")))
    assert [r[0] for r in keys.collect()] == ["n::1", "n::u", None]


def captures():
    rows = [("s", "2024-01-01", "a", 100, "vnd"), ("s", "2024-01-01", "a", None, None), ("s", "2024-01-02", "a", 150, "vnd"), ("s", "2024-01-04", "a", 150, None), ("s", "2024-01-02", "b", 5, "negotiable"), ("t", "2024-01-04", "c", 1, "vnd")]
    return [(*r, i) for i, r in enumerate(rows)]


SCHEMA = "source string, crawl_date string, listing_id string, price_vnd long, price_unit string, n int"


def test_removed_and_changes(spark):
    t = gold.tables(spark.createDataFrame(captures(), SCHEMA), "n")
    assert sorted((r.dedup_key, r.last_seen_before_removed, r.snapshot_date) for r in t["removed_listings"].collect()) == [("s::b", "2024-01-02", "2024-01-04")]
    snap = {(r.dedup_key, r.snapshot_date): r for r in t["snapshots"].collect()}
    assert snap["s::a", "2024-01-02"].snapshot_status == "changed_price" and snap["s::a", "2024-01-02"].price_change_pct == 0.5
    assert snap["s::a", "2024-01-04"].snapshot_status == "active" and not snap["s::a", "2024-01-04"].is_price_changed
    assert daily.removed(t["daily"], per_source=True).count() == 1
    assert daily.removed(t["daily"].filter("crawl_date = '2024-01-01'")).count() == 0
    assert all(df.count() >= 0 for df in gold.tables(spark.createDataFrame([], SCHEMA), "n").values())
    assert gold.tables(spark.createDataFrame([], SCHEMA), "n")["summary"].first().duplicate_rate == 0.0


def test_rerun_is_stable(spark):
    df = spark.createDataFrame(captures(), SCHEMA)
    a, b = (sorted(map(str, gold.tables(x)["daily"].collect())) for x in (df, df.repartition(5)))
    assert a == b


def test_gates(spark):
    q = spark.createDataFrame([(0, None, 0.6), (5, 0.95, 0.1)], "total_records long, parse_success_rate double, duplicate_rate double")
    got = checks.source_gate(q).collect()
    assert got[0].gate_reasons == ["total_records 0 below minimum 1", "parse_success_rate 0 below minimum 0.9", "duplicate_rate 0.6 above maximum 0.5"] and got[1].gate == "pass"
    df = spark.createDataFrame([(True, "success", True, 500, 0), (False, "failed", True, 500, 0), (False, "success", False, 500, 0), (False, "success", True, 0, 0), (False, "success", True, 99, 0), (False, "success", True, 100, 2), (False, "success", True, 100, 0)], "sk boolean, st string, v boolean, n long, w int")
    c = F.col
    assert [r[0].decision for r in df.select(checks.publish_gate(c("sk"), c("st"), c("v"), c("n"), c("w"))).collect()] == ["skipped", "blocked", "blocked", "blocked", "blocked", "published_with_warnings", "published"]
    df = spark.createDataFrame([(0.99, 0.99, 0.1, 0.1), (0.94, 0.95, 0.1, 0.1), (0.99, 0.99, 0.18, 0.1), (0.5, 0.99, 0.1, 0.1), (0.99, 0.99, 0.9, 0.1)], "p double, b double, r double, rb double")
    assert [r[0] for r in df.select(checks.quality_class_to_baseline(c("p"), c("b"), [(c("r"), c("rb"))])).collect()] == ["excellent", "good", "good", "poor", "poor"]
    a, b = (spark.createDataFrame([(x,) for x in v], "d string") for v in (("1", "2"), ("2", "3")))
    assert sorted(map(tuple, checks.date_differences(a, b, "d").collect())) == [("1", "left"), ("3", "right")]


def test_warehouse(spark):
    rows = [("2024-05-14", "batdongsan", "123", "Hà Nội", "Q1", "P1", "house", "batdongsan::123"), ("2024-05-14", "nhatot", None, None, None, None, "land", "nhatot::abc"), ("2024-05-15", "nhatot", "999", "Hà Nội", None, None, None, "nhatot::999"), ("2024-05-15", "nhatot", "999", "Hà Nội", None, None, None, "nhatot::999"), ("2024-05-15", None, "1", None, None, None, None, "x")]
    snap = typed(spark.createDataFrame(rows, "snapshot_date string, source string, listing_id string, city_norm string, district_norm string, ward_norm string, property_type_group string, dedup_key string")).withColumn("snapshot_status", F.lit("active"))
    quality = spark.createDataFrame([("2024-05-14", "batdongsan", 3)], "crawl_date string, source string, total_records long")
    assert {(r.source_key, r.source_code, r.is_active) for r in warehouse.dim_source(snap, quality).collect()} == {(0, "unknown", False), (1, "batdongsan", True), (2, "nhatot", True)}
    facts = warehouse.fact_listing(snap)
    assert facts.count() == 3
    assert {(r.location_level, r.location_confidence) for r in warehouse.dim_location(snap).collect()} == {("ward", 1.0), ("city", 0.4), ("unknown", 0.0)}
    for key, dim in (("location_key", warehouse.dim_location(snap)), ("listing_key", warehouse.dim_listing(snap)), ("property_type_key", warehouse.dim_property_type(snap)), ("source_key", warehouse.dim_source(snap, quality))):
        assert checks.orphans(facts, key, dim).count() == 0
    assert warehouse.fact_quality(quality).first().duplicate_rate == 0.0


def test_baseline(spark):
    df = spark.createDataFrame([("a", i, float(i) if i != 2 else None) for i in range(5)], "s string, d int, m double")
    got = [(r.m_baseline, r.m_delta_pct) for r in marts.baseline(df, "d", ["m"], rows=2, by=["s"]).orderBy("d").collect()]
    assert got == [(None, None), (0.0, None), (0.5, None), (1.0, 2.0), (3.0, pytest.approx(1 / 3))]


def test_stream_equals_batch(spark, tmp_path):
    rows = captures()
    for i, part in enumerate((rows[:2], rows[2:5], rows[5:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = stream.start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "days"), str(tmp_path / "check"), "n")
        query.awaitTermination()
    columns = ["crawl_date", "dedup_key", "n", "quality_score"]
    got = tables.read_hive(spark, str(tmp_path / "days")).select(columns).collect()
    expected = gold.tables(spark.createDataFrame(rows, SCHEMA), "n")["daily"].select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_stream_windows(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    rows = [("s", "1", base), ("s", "1", base + datetime.timedelta(hours=1)), ("s", "2", base), ("s", "9", base + datetime.timedelta(days=9))]
    spark.createDataFrame(rows, "source string, listing_id string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    read = spark.readStream.schema("source string, listing_id string, ts timestamp").parquet(str(tmp_path / "in"))
    for name, df in (("firsts", stream.first_captures(read, "ts").select("dedup_key")), ("counted", stream.counts(read, "ts"))):
        query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r[0] for r in spark.table("firsts").collect()) == ["s::1", "s::2", "s::9"]
    assert [(r.source, r.captures) for r in spark.table("counted").collect()] == [("s", 3)]
