"""Call log of the model: rate limits in a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.calls import error_class
from .ordered import carried, numbered, task_of, with_summary


def rate_limit_streaks(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``classe``, ``sequencia`` (rate limits since the last success) and ``disparo``.

    Other errors do not end a streak. The breaker opens at a rate limit that makes the streak two
    or more. ``call_id`` is the unique order of the calls, of any type; ``keys`` part logs of
    several sessions. One log may be all of the data: each task counts over its own range of
    calls, and what a range hands on, its rate limits and those before its last success, is one row.
    """
    classed = log.withColumn("classe", F.when(~F.col("ok"), error_class(F.col("error"))))
    rows = numbered(classed, [*keys, "call_id"]).withColumn("_task", task_of())
    here = Window.partitionBy(*keys, "_task").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    limited = F.coalesce(F.col("classe") == "rate_limit", F.lit(False))
    rows = rows.withColumn("_cum", F.sum(limited.cast("bigint")).over(here))
    rows = rows.withColumn("_base", F.max(F.when(F.col("ok"), F.col("_cum"))).over(here))

    pieces = rows.groupBy(*keys, "_task").agg(F.max("_cum").alias("_total"), F.max("_base").alias("_reset"))
    pieces = carried(pieces, keys, "_total", "_before")
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("_before") + F.col("_reset")).over(earlier), F.lit(0))
    pieces = pieces.select(*keys, "_task", (F.col("_before") - reached).alias("_carried"))

    streak = F.coalesce(F.col("_cum") - F.col("_base"), F.col("_carried") + F.col("_cum"))
    return with_summary(rows, pieces, keys).select(
        *classed.columns, streak.alias("sequencia"), (limited & (streak >= P.RATE_LIMIT_STREAK)).alias("disparo")
    )
