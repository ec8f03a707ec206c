"""Ordered work on groups of any size.

A window over a whole group puts the group into one task, and one group may hold a third of all
rows. So rows are dealt out to tasks by range of group and order: windows run over the rows of a
group in one task, and only one summary row per group and task crosses tasks. Order values may be
of any kind and have gaps of any width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut_lineage, keyed

#: Characters of one joined text at most; longer texts come in parts.
PART_CHARS = 1 << 24


def same(names: dict[str, str]) -> Column:
    """Equality of pairs of columns, null being equal to null."""
    on = F.lit(True)
    for left, right in names.items():
        on = on & F.col(left).eqNullSafe(F.col(right))
    return on


def numbered(df: DataFrame, order: Sequence[Column | str], row: str = "_row") -> DataFrame:
    """The rows by range of ``order``, sorted, with ``row``: task number (from bit 33 on) and place in the task.

    ``row`` orders all rows. They are written once, so that every reader sees the same numbers.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ranged.withColumn(row, F.monotonically_increasing_id()))


def task_of(row: str = "_row") -> Column:
    return F.shiftright(F.col(row), 33)


def carried(pieces: DataFrame, keys: Sequence[str], total: str, name: str) -> DataFrame:
    """Adds to the summary rows of ``keys`` and ``_task`` what ``total`` adds up to in earlier tasks."""
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn(name, F.coalesce(F.sum(total).over(before), F.lit(0)))


def with_summary(rows: DataFrame, pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the summary of their group and task. Without keys there is one summary row per task."""
    at = {c: f"_of_{c}" for c in (*keys, "_task")}
    pieces = pieces.withColumnsRenamed(at)
    found = rows.join(keyed(pieces) if keys else F.broadcast(pieces), same(at))
    return found.drop(*at.values())


def dense_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... along ``order`` in each group of ``keys`` (in the whole frame without keys).

    Equal rows get different numbers; null keys are a group. ``df`` must not have columns that
    begin with an underscore.
    """
    rows = numbered(df, [*keys, *order]).withColumn("_task", task_of())
    pieces = rows.groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    placed = with_summary(rows, carried(pieces, keys, "_n", "_before"), keys)
    return placed.select(*df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias(name))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], weight: str, name: str = "before") -> DataFrame:
    """Adds ``name``: what ``weight`` adds up to over the rows before, along ``order`` in each group of ``keys``."""
    rows = numbered(df, [*keys, *order]).withColumn("_task", task_of())
    pieces = rows.groupBy(*keys, "_task").agg(F.sum(weight).alias("_n"))
    inside = Window.partitionBy(*keys, "_task").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    added = rows.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    placed = with_summary(added, carried(pieces, keys, "_n", "_before"), keys)
    return placed.select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    sep: str,
    out: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Join ``text`` along ``order`` with ``sep`` into parts: ``keys``, ``part_no``, ``out``.

    ``order`` is unique in a group. Part k holds the characters from ``k * part_chars`` on of the
    joined text, ``part_chars`` at most, so no value is longer whatever the size of a group or of one
    text; the parts one behind the other are the whole. A running sum of lengths, for which no text
    is moved, tells in which part each text begins, and a text that goes on over the end of a part
    is cut there. A group whose texts are all empty has an empty part 0. Null text counts as ''.
    """
    at = [*keys, *order]
    sized = df.select(*at, (F.length(F.coalesce(F.col(text), F.lit(""))) + len(sep)).cast("bigint").alias("size"))
    placed = running_totals(sized, keys, order, "size", "start")
    rows = df.select(*at, F.concat(F.lit(sep), F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    # The separator before the first text is no part of the whole.
    begin = F.col("start") - len(sep)
    of = {c: f"_of_{c}" for c in at}
    placed = placed.select(*[F.col(c).alias(o) for c, o in of.items()], begin.alias("_begin"))
    # Both sides have a row per text, so neither is ever the small one.
    met = rows.join(keyed(placed), same(of))
    first = F.greatest(F.col("_begin"), F.lit(0))
    last = F.greatest(F.col("_begin") + F.length("_text") - 1, first)
    parts = F.sequence(F.floor(first / part_chars), F.floor(last / part_chars))
    cut = met.select(*at, "_begin", "_text", F.explode(parts).alias("part_no"))
    begin = F.greatest(F.col("part_no") * part_chars, F.lit(0)) - F.col("_begin")
    piece = F.substr("_text", F.greatest(begin, F.lit(0)).cast("int") + 1, (part_chars + F.least(begin, F.lit(0))).cast("int"))
    return (
        cut.groupBy(*keys, "part_no")
        .agg(F.array_sort(F.collect_list(F.struct(*order, piece.alias("t")))).alias("_pieces"))
        .select(*keys, "part_no", F.array_join(F.col("_pieces.t"), "").alias(out))
    )
