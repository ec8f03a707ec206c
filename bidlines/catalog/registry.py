"""Registry of the queries over the driver's tables, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """Columns of a table for work that is heavy per row, dealt out evenly whatever the files are like."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return getattr(self, name).select(*columns).repartition(n, columns[0])


def query(sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under its own name."""

    def register(f: Callable[[Tables], DataFrame]):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = sql
        return f

    return register


def text(*parts) -> Column:
    """Concatenation of plain strings and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
