"""Tables laid out by notice, of which a run reads only the share its notices lie in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET, BUCKETS = "balde", 256


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_by_notice(df: DataFrame, path: str, key: str = "arquivo_json", buckets: int = BUCKETS, mode: str = "append") -> None:
    """Write rows in folders by a hash of their notice. Dealt out by range, so one notice may be several files."""
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    placed.repartitionByRange(BUCKET, *df.columns).write.mode(mode).partitionBy(BUCKET).parquet(path)


def by_notice(spark: SparkSession, path: str, schema: str, key: str = "arquivo_json", buckets: int = BUCKETS) -> Callable[[DataFrame], DataFrame]:
    """A function that gives the rows of a table of ``write_by_notice`` that a frame of notices may need.

    The buckets of the notices, ``buckets`` numbers at most, become a filter on the folders; the rows
    are still to be joined with the notices.
    """
    def read(notices: DataFrame) -> DataFrame:
        wanted = [row[0] for row in notices.select(bucket_of(F.col(key), buckets)).distinct().collect()]
        rows = spark.read.schema(f"{schema}, {BUCKET} int").parquet(path)
        return rows.where(F.col(BUCKET).isin(wanted)).drop(BUCKET)

    return read
