"""Nested notice rows out of flat items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ITEM_FIELDS, NOTICE_FIELDS
from ..sources.shared import keyed
from .ordered import dense_positions

#: Items of one nested row; a notice of more has several rows.
PART_ROWS = 10_000


def nest_items(items: DataFrame, keys: Sequence[str] = ("arquivo_json",), part_rows: int = PART_ROWS) -> DataFrame:
    """Items of a notice as ordered arrays: ``keys``, ``parte``, ``itens_extraidos``.

    Items are numbered along ``att_pos, block_pos`` and part k holds the numbers from
    ``k * part_rows`` on. Every notice has a part 0; the arrays in the order of ``parte`` are
    the whole list.
    """
    placed = dense_positions(items.select(*keys, "att_pos", "block_pos", *ITEM_FIELDS), keys, ["att_pos", "block_pos", *ITEM_FIELDS])
    entry = F.struct("pos", F.struct(*ITEM_FIELDS).alias("item"))
    return (
        placed.groupBy(*keys, F.floor(F.col("pos") / part_rows).alias("parte"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(*keys, "parte", F.col("_entries.item").alias("itens_extraidos"))
    )


def nest_notices(headers: DataFrame, attachments: DataFrame, items: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Result rows: header, processed attachment names, item array, ``parte``. Notices without items stay."""
    nested = nest_items(items, part_rows=part_rows)
    empty_names = F.array().cast("array<string>")
    empty_items = F.array().cast(nested.schema["itens_extraidos"].dataType)
    return (
        headers.select(*NOTICE_FIELDS)
        .join(keyed(attachments), "arquivo_json", "left")
        .join(keyed(nested), "arquivo_json", "left")
        .select(
            *NOTICE_FIELDS,
            F.coalesce("anexos_processados", empty_names).alias("anexos_processados"),
            F.coalesce("itens_extraidos", empty_items).alias("itens_extraidos"),
            F.coalesce("parte", F.lit(0).cast("bigint")).alias("parte"),
        )
    )
