"""The daily operators on a stream of captures.

A capture is kept once within the watermark, and each micro-batch brings the day's best rows up to date in a table
partitioned by day: only the days in the batch are read and rewritten, so work follows the batch, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.daily import best_of_day, keyed
from ..sources.tables import exists


def first_captures(stream: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """Keyed captures, each key once within the watermark."""
    return keyed(stream).withWatermark(time, late).dropDuplicatesWithinWatermark(["source", "dedup_key"])


def counts(stream: DataFrame, time: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Captures of each window of event time and source, final once the watermark has passed."""
    windowed = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), "source")
    return windowed.agg(F.count("*").alias("captures")).select(F.col("w.start").alias("start"), "source", "captures")


def merge_days(batch: DataFrame, table: str, tiebreak: str) -> None:
    """Brings the best rows of the batch's days up to date in the table. Running it again gives the same table."""
    spark: SparkSession = batch.sparkSession
    new = keyed(batch)
    if exists(spark, f"{table}/crawl_date=*"):
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        days = new.select("crawl_date").distinct()
        old = spark.read.parquet(table).join(days, "crawl_date", "left_semi").drop("quality_score")
        new = old.unionByName(new, allowMissingColumns=True)
    best = best_of_day(new, tiebreak)
    part = f"{table}__next"
    best.write.mode("overwrite").partitionBy("crawl_date").parquet(part)
    spark.read.parquet(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("crawl_date").parquet(table)


def start(stream: DataFrame, table: str, checkpoint: str, tiebreak: str) -> StreamingQuery:
    """Keeps the table of daily best rows up to date from a stream, until all that is there has been read."""

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            merge_days(batch, table, tiebreak)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
