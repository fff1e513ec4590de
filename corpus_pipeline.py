"""A corpus pipeline over `documents`: language, near copies, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import _common as common
from tideline.llm import decontamination, language, near_duplicates, packing, substrings


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: texts without a letter and texts unlike all learned languages go."""
    names = common.free_names(docs, "lang_pred", "score", "rejected")
    return language.identify(docs, language.fitted(docs), names).filter(~F.col(names[2])).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return near_duplicates.without_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier; documents that lose all their words go."""
    rows, key = common.keyed(docs)
    kept = substrings.without_repeats(rows, key=key).filter("n_removed > 0")
    kept = kept.select(F.col("rid").alias(key), F.col("kept").alias(f"{key}kept"), (F.col("n_removed") < F.col("n_words")).alias(f"{key}left"))
    joined = rows.join(kept, key, "left").filter(F.coalesce(f"{key}left", F.lit(True)))
    cut, short = F.col(f"{key}left"), F.col(f"{key}kept")
    text = F.when(cut, short).otherwise(F.col("text"))
    size = F.when(cut, F.length(short).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*(text.alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences for training, as pieces of documents with a checksum of their ids."""
    return packing.packed_digest(packing.pack(docs))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express the fitted language model and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
