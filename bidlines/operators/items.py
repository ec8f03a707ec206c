"""Item parsers: text in, one row per valid item out. Narrow: no shuffle, no UDF.

A text is split into blocks, and a block with an item header and a quantity is an item.
``keys`` name the columns that identify a text; ``block_pos`` keeps the order inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import clean_description, clean_unit, drop_lines, first_group, keep_label_value, split_at

ITEM_COLUMNS = ("block_pos", "lote", "item", "objeto", "quantidade", "unidade_fornecimento")


def split_blocks(df: DataFrame, keys: Sequence[str], text: Column, pattern: str) -> DataFrame:
    """One row per block of ``text``: ``keys``, ``block_pos``, ``block`` (without leading blanks).

    Blank blocks go later with all others that have no item header. (The outer form of the
    generator keeps the planner from adding a filter that would split each text once more.)
    """
    return df.select(*keys, F.posexplode_outer(split_at(text, pattern)).alias("block_pos", "block")).select(
        *keys,
        F.col("block_pos").cast("bigint").alias("block_pos"),
        F.ltrim(F.col("block"), F.lit(P.BLANKS)).alias("block"),
    )


def _once(df: DataFrame, kept: Sequence[str], **columns: Column) -> DataFrame:
    """``kept`` and ``columns``, which are evaluated once per row.

    As columns of a projection they would be evaluated again in each filter on them, since filters
    are pushed down; a filter does not pass the outer form of a generator.
    """
    return df.select(*kept, F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def notice_blocks(df: DataFrame, keys: Sequence[str], itens_col: str = "itens") -> DataFrame:
    """Blocks of a notice's own item text (array of strings), split at rules and item numbers."""
    return split_blocks(df, keys, F.array_join(itens_col, "\n"), P.NOTICE_SPLIT)


def attachment_blocks(df: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """Blocks of an attachment held as one text per row, split at item numbers only."""
    return split_blocks(df, keys, F.col(text_col), P.ITEM_START)


def _block_items(
    blocks: DataFrame, keys: Sequence[str], header: str, quantity: str, description: Column, lote: Column
) -> DataFrame:
    """Blocks with a header and a quantity, both at least 1, as items; other blocks are dropped."""
    block, head = F.col("block"), F.col("head")
    of_block = [*keys, "block_pos", "block"]
    # Numbers are tested as text first: a failing cast costs far more than a pattern.
    headed = _once(blocks, of_block, head=F.regexp_extract(block, header, 0)).where(head.rlike(P.POSITIVE_HEAD))
    number = F.regexp_extract(head, P.ATTACHMENT_HEADER, 1)
    found = _once(headed, [*of_block, "head"], number=number, quantity=F.regexp_extract(block, quantity, 1))
    title = F.regexp_extract(head, P.ATTACHMENT_HEADER, 2)
    items = found.where(F.col("quantity").rlike(P.POSITIVE)).select(
        *keys,
        "block_pos",
        lote.alias("lote"),
        F.col("number").try_cast("bigint").alias("item"),
        clean_description(F.concat(title, F.lit(" "), description)).alias("objeto"),
        F.col("quantity").try_cast("bigint").alias("quantidade"),
        clean_unit(F.regexp_extract(block, P.SUPPLY_UNIT, 1)).alias("unidade_fornecimento"),
    )
    # Only numbers too large for bigint are left to refuse here.
    return items.where(F.col("item").isNotNull() & F.col("quantidade").isNotNull())


def items_of_notice_blocks(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of notice blocks. The header may be on any line; these texts carry no lot."""
    description = drop_lines(F.col("block"), P.NOTICE_SKIP_PREFIXES)
    return _block_items(
        blocks, keys, P.NOTICE_HEADER, P.NOTICE_QUANTITY, description, F.lit(None).cast("string")
    )


def items_of_attachment_blocks(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of attachment blocks; ``lote`` is the group named inside the block, if any."""
    kept = drop_lines(F.col("block"), P.ATTACHMENT_SKIP_PREFIXES, digits=True)
    description = keep_label_value(kept, P.DETAIL_LABEL)
    return _block_items(
        blocks, keys, P.ATTACHMENT_HEADER, P.ATTACHMENT_QUANTITY, description, inline_lote(F.col("block"))
    )


def inline_lote(block: Column) -> Column:
    """Group named in the block: upper case, with a leading ``G``; null if there is none."""
    name = F.upper(first_group(block, P.INLINE_GROUP))
    return F.when(name.startswith("G"), name).otherwise(F.concat(F.lit("G"), name))


def parse_notice_items(df: DataFrame, keys: Sequence[str], itens_col: str = "itens") -> DataFrame:
    """Items of the notice's own text."""
    return items_of_notice_blocks(notice_blocks(df, keys, itens_col), keys)


def clean_items(items: DataFrame) -> DataFrame:
    """Clean description and unit once more, as is done to every item that came from an attachment."""
    return items.withColumns(
        {
            "objeto": clean_description(F.col("objeto")),
            "unidade_fornecimento": clean_unit(F.col("unidade_fornecimento")),
        }
    )
