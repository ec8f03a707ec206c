"""Lots of attachment items: the group composition section and how a lot is chosen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import first_group
from ..sources.shared import keyed


def group_entries(section: Column) -> Column:
    """Array of ``(item, lote, pos)`` named in the text of one composition section."""
    blocks = F.regexp_extract_all(section, F.lit(P.GROUP_BLOCK), F.lit(0))

    def entries(block: Column, pos: Column) -> Column:
        name = F.regexp_extract(block, P.GROUP_NAME, 1)
        body = F.regexp_replace(block, P.GROUP_NAME, "")
        numbers = F.regexp_extract_all(body, F.lit(P.GROUP_ITEM), F.lit(1))
        return F.transform(
            numbers, lambda n: F.struct(n.try_cast("bigint").alias("item"), name.alias("lote"), pos.alias("pos"))
        )

    return F.flatten(F.transform(blocks, entries))


def group_mapping_of_sections(sections: DataFrame, keys: Sequence[str], section_col: str = "section") -> DataFrame:
    """``keys``, ``item``, ``lote``: the last group that names an item wins."""
    named = sections.select(*keys, F.explode_outer(group_entries(F.col(section_col))).alias("e")).where("e.item IS NOT NULL")
    return named.groupBy(*keys, F.col("e.item").alias("item")).agg(F.max_by("e.lote", "e.pos").alias("lote"))


def group_mapping(df: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """Group mapping of attachments held as one text per row."""
    section = first_group(F.col(text_col), P.GROUP_SECTION)
    return group_mapping_of_sections(
        df.select(*keys, section.alias("section")).where("section IS NOT NULL"), keys
    )


def resolve_lote(inline: Column, mapped: Column) -> Column:
    """A group named beside the item beats the composition section; else null."""
    return F.coalesce(inline, mapped)


def with_group_mapping(items: DataFrame, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fill ``lote`` from the mapping. Joined on text and item number, so one text spreads over tasks."""
    known = mapping.withColumnRenamed("lote", "mapped_lote")
    return items.join(keyed(known), [*keys, "item"], "left").select(
        *keys,
        "block_pos",
        resolve_lote(F.col("lote"), F.col("mapped_lote")).alias("lote"),
        "item",
        "objeto",
        "quantidade",
        "unidade_fornecimento",
    )
