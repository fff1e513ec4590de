"""Session settings that the engine relies on; a cluster's own settings win over them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "tideline", **settings: str) -> SparkSession:
    """A session with DEFAULTS, then environment overrides (TIDELINE_MASTER, TIDELINE_SHUFFLE_PARTITIONS), then settings."""
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULTS)
    if master := os.environ.get("TIDELINE_MASTER"):
        builder = builder.master(master)
    if partitions := os.environ.get("TIDELINE_SHUFFLE_PARTITIONS"):
        conf["spark.sql.shuffle.partitions"] = partitions
    for key, value in {**conf, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
