"""Row keys don't depend on how a read splits the files, and clash with no column."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tideline.llm import _common as common
from tideline.llm import decontamination, near_duplicates, warc


def keys(df):
    rows, key = common.keyed(df)
    return {(r["n"], r[key]) for r in rows.select("n", key).collect()}


@pytest.fixture
def splits(spark):
    """Sets the least number of splits of a read; small files are cut too."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in names}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda n: spark.conf.set("spark.sql.files.minPartitionNum", str(n))
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def table(spark, tmp_path):
    """Rows of several files with row groups of a few hundred rows, in a folder with odd characters."""
    path = f"{tmp_path}/a b%20c"
    words = F.concat_ws(" ", *(F.concat(F.lit("w"), (F.col("id") * 31 + k) % 997) for k in range(40)))
    df = spark.range(900).select(F.col("id").alias("n"), (F.col("id") % 450).alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"))
    df.repartition(3).write.option("parquet.block.size", 8000).parquet(path)
    return path


def test_keys_stay_when_splits_change(spark, table, splits):
    splits(2)
    few, parts = keys(spark.read.parquet(table)), spark.read.parquet(table).rdd.getNumPartitions()
    filtered = keys(spark.read.parquet(table).filter("n % 2 = 0").select("n", "text"))
    splits(16)
    assert spark.read.parquet(table).rdd.getNumPartitions() > parts
    many = keys(spark.read.parquet(table))
    assert few == many and len({k for _, k in many}) == 900 and filtered < many


def test_results_stay_when_splits_change_between_reads(spark, table, splits):
    """The class's rows are found under one split of the files and taken under another."""
    for stage in (lambda d: near_duplicates.without_near_duplicates(d), lambda d: corpus_pipeline.substring_stage(spark, d, "")):
        splits(2)
        plan = stage(spark.read.parquet(table))
        splits(16)
        late = sorted((r.n, r.text) for r in plan.collect())
        assert late == sorted((r.n, r.text) for r in stage(spark.read.parquet(table)).collect())
    items = spark.createDataFrame([(1, " ".join(f"w{(31 * 7 + k) % 997}" for k in range(40)))], "item_id long, text string")
    splits(2)
    plan = decontamination.without_leaks(spark.read.parquet(table), items)
    splits(16)
    kept = {r.n for r in plan.collect()}
    assert 7 not in kept and len(kept) > 800


def test_written_inputs_and_clashing_names(spark, table):
    docs = spark.read.parquet(table)
    made = docs.filter("n < 100").withColumn("__row_key", F.lit("x")).withColumn("__ROW_KEY_", F.lit("y"))
    for df in (made, made.withColumn("r", F.rand()), spark.createDataFrame(made.limit(50).collect()), made.union(made), made.withColumn("e", F.explode(F.array(F.lit(1), F.lit(2)))), spark.read.parquet(table, table)):
        rows, key = common.keyed(df)
        assert rows.columns == [*df.columns, key] and key not in df.columns
        got = [r[key] for r in rows.collect()]
        assert len(got) == len(set(got)) == df.count()
    for stage in (near_duplicates.without_near_duplicates, lambda d: corpus_pipeline.substring_stage(spark, d, "")):
        kept = stage(made)
        assert kept.columns == made.columns and {r["__row_key"] for r in kept.collect()} == {"x"}


def test_archives_under_another_split(spark, table, splits):
    pages = spark.read.parquet(table).select(F.col("n").alias("page_id"), F.lit("http://a.org/").alias("url"), F.col("doc_id").cast("string").alias("html"))
    splits(2)
    records = warc.archive_round_trip(pages)
    splits(16)
    assert {(r.page_id, r.refers_to) for r in records.collect()} == {(n, n - 450 if n >= 450 else None) for n in range(900)}


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *_: None)}))

    with pytest.raises(RuntimeError):
        common.shared_dir(Elsewhere)
