"""Choice of the source a notice takes its items from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import percentage
from ..sources.shared import cut_lineage, keyed

KEY = "arquivo_json"


Source = DataFrame | Callable[[DataFrame], DataFrame]


def cascade(notices: DataFrame, *sources: Source, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of each notice's first source that has any, with ``tier`` counted from 1.

    A source is a frame, or a function of the notices that are left that gives their rows. Each is
    evaluated once, for the notices the sources before it left without rows, and kept (written to
    the shared folder, unless ``keep`` says otherwise). All rows of a tier stay, duplicates too.
    """
    keep = keep or cut_lineage
    left, found = notices, []
    for tier, source in enumerate(sources, 1):
        rows = source(left) if callable(source) else source.join(keyed(left.select(KEY).distinct()), KEY, "left_semi")
        found.append(keep(rows))
        left = unsolved(left, found[-1])
    return reduce(DataFrame.unionByName, [rows.withColumn("tier", F.lit(tier)) for tier, rows in enumerate(found, 1)])


def unsolved(notices: DataFrame, *solved: DataFrame) -> DataFrame:
    """Notices without a row in any of ``solved``."""
    for rows in solved:
        notices = notices.join(keyed(rows.select(KEY).distinct()), KEY, "left_anti")
    return notices


def first_nonempty(
    rows: DataFrame, keys: Sequence[str] = (KEY,), pos: str = "att_pos", keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows of the first position that has any, per key. The rows are evaluated once and kept."""
    rows = (keep or cut_lineage)(rows)
    first = rows.groupBy(*keys).agg(F.min(pos).alias(pos))
    return rows.join(keyed(first), [*keys, pos], "left_semi")


def tier_coverage(items: DataFrame, notices: DataFrame) -> DataFrame:
    """Items and notices per tier and the share of all notices; tier 0 is notices without items."""
    per_notice = items.groupBy(KEY).agg(F.min("tier").alias("tier"), F.count(F.lit(1)).alias("n"))
    per_tier = (
        notices.select(KEY)
        .join(keyed(per_notice), KEY, "left")
        .groupBy(F.coalesce("tier", F.lit(0)).alias("tier"))
        .agg(F.count(F.lit(1)).alias("licitacoes"), F.coalesce(F.sum("n"), F.lit(0)).alias("itens"))
    )
    # At most four rows are left here.
    total = F.sum("licitacoes").over(Window.partitionBy(F.lit(1)))
    return per_tier.select("tier", "licitacoes", "itens", percentage(F.col("licitacoes"), total).alias("pct"))


def pending(notices: DataFrame, done: DataFrame) -> DataFrame:
    """Notices that have no result yet."""
    return notices.join(keyed(done.select(KEY).distinct()), KEY, "left_anti")
