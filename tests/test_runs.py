"""Targets, totals, scorecards and checks between tables."""

import json

from pyspark.sql import functions as F

from tideline.operators import runs
from tideline.plans import gold


def test_small_functions(spark, tmp_path):
    df = spark.createDataFrame([("Sale", None, "NhaTot "), (None, "cho-thue-x", None), ("x", "y", "b")], "b string, c string, s string")
    assert [tuple(r) for r in df.select(runs.transaction(F.col("b"), F.col("c")), runs.parser_of(F.col("s"))).collect()] == [("s", "api"), ("u", "page"), (None, "page")]
    places = spark.createDataFrame([("p", None), ("q", ["z"])], "place string, categories array<string>")
    kinds = spark.createDataFrame([("a",), ("b",)], "category string")
    assert sorted(map(tuple, runs.expanded_targets(places, kinds).collect())) == [("p", "a"), ("p", "b"), ("q", "z")]
    assert tuple(runs.api_totals(spark.createDataFrame([(41,), (20,)], "total long")).first()) == (61, 4)
    for name, size in (("a", 3), ("b", 5)):
        (tmp_path / name).write_bytes(b"x" * size)
    assert tuple(runs.file_sizes(spark, str(tmp_path)).first()) == (2, 4.0, 3, 5, 2)


def test_first_record(spark):
    deep = {"a": [1, {"b": {"x": 2}}, {"c": {"body": "é", "d": {"subject": 1}}}]}
    df = spark.createDataFrame([(json.dumps(deep),), ("{bad",), (None,), ("[]",)], "t string")
    got = [r[0] for r in df.select(runs.first_record(F.col("t"))).collect()]
    assert json.loads(got[0])["body"] == "é" and got[1:] == [None, None, None]


def test_summaries(spark):
    silver = spark.createDataFrame([(True, 1), (False, 2)], "is_missing_price boolean, x int")
    assert runs.flag_summary(silver, 4).first().asDict() == {"total_records": 2, "is_missing_price_rate": 0.5, "parse_success_rate": 0.5}
    card = runs.scorecard(spark.createDataFrame([("r", 90, 10), ("e", None, None)], "run_id string, total_silver_records long, quarantined long")).collect()
    assert [(r.total_records, r.quarantine_rate, r.blocked_rate) for r in card] == [(90.0, 0.1, 0.0), (None, 0.0, 0.0)]


def test_table_checks(spark):
    rows = [("s", f"2024-01-0{d}", str(i), i) for d in (1, 2, 4) for i in range(d + 3)]
    tables = gold.tables(spark.createDataFrame(rows, "source string, crawl_date string, listing_id string, price_vnd long"))
    assert {r.check: r.violations for r in runs.table_checks(tables).collect()} == dict.fromkeys(("current_rows", "market_rows", "market_days", "quality_days"), 0)
    broken = {**tables, "current_listings": tables["current_listings"].limit(1)}
    assert {r.check for r in runs.table_checks(broken).filter("violations > 0").collect()} == {"current_rows"}
