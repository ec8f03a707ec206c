"""Session settings the jobs are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "bidlines", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive planning on; every setting may be given by ``conf`` or the cluster.

    Skewed joins are split even where that costs one more exchange. The number of shuffle
    partitions is left to the cluster, where adaptive execution merges small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # HotSpot does not compile larger methods; Spark then splits the stage instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
