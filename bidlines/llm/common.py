"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlines.sources.shared import cut_lineage, discard  # noqa: F401 - for the operators

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: A word between white space, and a word of letters and digits of lower-cased text.
WORD = r"[^\x20\x09-\x0D]+"
TERM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under its own name, beside the SQL that checks it."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            CHECKS[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame does not have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """What is run inside gets n rows at most in one Arrow batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int, size: int):
    """What is run inside gets so many rows at most in one Arrow batch, and about so many bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        with rows_per_batch(spark, rows):
            yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def terms(c: Column) -> Column:
    """Lower-cased words of letters and digits, in order; empty for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(c, F.lit(""))), TERM_GAP), lambda w: w != "")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges, root being the smallest node reachable.

    Alternating large-star and small-star rounds: each round hangs the neighbours of a node on
    the smallest of them. A round is joins and minima only, is written to the shared folder, and
    the driver sees one count and one checksum of it. Null ends and loops are left out.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    links = cut_lineage(links)
    seen = _mark(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        links = cut_lineage(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        now = _mark(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
