"""Markdown text out of table cells, pages and blocks, in document order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_cell, strip
from .ordered import PART_CHARS, ordered_text


def _row_line(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def _rows(cells: DataFrame, keys: Sequence[str], text: Column) -> DataFrame:
    """One row per table row that is not all blank: its cell texts in column order."""
    return (
        cells.groupBy(*keys, "row_no")
        .agg(F.array_sort(F.collect_list(F.struct("col_no", text.alias("t")))).alias("_cells"))
        .select(*keys, "row_no", F.col("_cells.t").alias("cells"))
        .where(F.exists("cells", lambda t: t != ""))
    )


def table_lines(cells: DataFrame, keys: Sequence[str] = ("doc", "table_no")) -> DataFrame:
    """Markdown per table row (``keys, row_no, line``): padded to the widest row of its table.

    The first row kept is the header and carries the rule line under it.
    """
    rows = _rows(cells, keys, clean_cell(F.col("text")))
    shape = rows.groupBy(*keys).agg(F.max(F.size("cells")).alias("width"), F.min("row_no").alias("header_row"))
    padding = F.array_repeat(F.lit(""), F.col("width") - F.size("cells"))
    line = _row_line(F.concat("cells", padding))
    rule = _row_line(F.array_repeat(F.lit("---"), F.col("width")))
    return rows.join(shape, list(keys)).select(
        *keys,
        "row_no",
        F.when(F.col("row_no") == F.col("header_row"), F.concat(line, F.lit("\n"), rule)).otherwise(line).alias("line"),
    )


def table_to_markdown(
    cells: DataFrame, keys: Sequence[str] = ("doc", "table_no"), part_chars: int = PART_CHARS
) -> DataFrame:
    """Markdown tables (``keys, part_no, markdown``); see ``ordered_text`` for parts."""
    return ordered_text(table_lines(cells, keys), keys, ["row_no"], "line", "\n", "markdown", part_chars)


def page_sections(pages: DataFrame, tables: DataFrame, keys: Sequence[str] = ("doc",)) -> DataFrame:
    """Section of each page that has any content (``keys, page_no, section``).

    Pages with tables: heading, tables in order, then the page text as context. Others: heading
    and text. ``tables`` holds ``keys, page_no, table_no, markdown`` (blank for an empty table).
    """
    on_page = [*keys, "page_no"]
    table = F.when(F.coalesce("markdown", F.lit("")) != "", F.struct("table_no", "markdown"))
    drawn = tables.groupBy(*on_page).agg(F.array_sort(F.collect_list(table)).alias("_tables"))
    text = strip(F.coalesce(F.col("text"), F.lit("")))
    number = F.col("page_no").cast("string")
    heading = F.concat(F.lit("### Página "), number)
    context = F.when(text != "", F.concat(F.lit("**Contexto da Página "), number, F.lit(":**\n"), text))
    with_tables = F.array_join(
        F.concat(F.array(heading), F.col("_tables.markdown"), F.array_compact(F.array(context))), "\n\n"
    )
    plain = F.when(text != "", F.concat(heading, F.lit("\n"), text))
    return (
        pages.join(drawn, on_page, "left")
        .select(*on_page, F.when(F.col("_tables").isNotNull(), with_tables).otherwise(plain).alias("section"))
        .where("section IS NOT NULL")
    )


def assemble_pages(
    pages: DataFrame, tables: DataFrame, keys: Sequence[str] = ("doc",), part_chars: int = PART_CHARS
) -> DataFrame:
    """Markdown of a paged document (``keys, part_no, markdown``), sections parted by a blank line."""
    sections = page_sections(pages, tables, keys)
    return ordered_text(sections, keys, ["page_no"], "section", "\n\n", "markdown", part_chars)


def assemble_blocks(blocks: DataFrame, keys: Sequence[str] = ("doc",), part_chars: int = PART_CHARS) -> DataFrame:
    """Paragraphs and Markdown tables in document order, blanks dropped, parted by a blank line."""
    kept = blocks.select(*keys, "block_no", strip(F.col("text")).alias("text")).where(F.col("text") != "")
    return ordered_text(kept, keys, ["block_no"], "text", "\n\n", "markdown", part_chars)


def sheet_lines(cells: DataFrame, sheets: DataFrame, keys: Sequence[str] = ("doc",)) -> DataFrame:
    """Lines of spreadsheets (``keys, table_no, row_no, line``); the name line is row -1.

    An empty cell that stands for several columns is dropped, a filled one is written once.
    ``sheets`` holds ``keys, table_no, name``.
    """
    sheet = [*keys, "table_no"]
    text = strip(F.coalesce(F.col("text"), F.lit("")))
    filled = cells.select(*sheet, "row_no", "col_no", "repeat", text.alias("text")).where(
        (F.coalesce("repeat", F.lit(1)) <= 1) | (F.col("text") != "")
    )
    body = _rows(filled, sheet, F.col("text")).select(*sheet, "row_no", _row_line(F.col("cells")).alias("line"))
    titles = sheets.where(F.col("name") != "").select(
        *sheet, F.lit(-1).alias("row_no"), F.concat(F.lit("\n### Tabela: "), F.col("name")).alias("line")
    )
    return titles.unionByName(body)


def sheets_to_text(
    cells: DataFrame, sheets: DataFrame, keys: Sequence[str] = ("doc",), part_chars: int = PART_CHARS
) -> DataFrame:
    """Text of spreadsheets (``keys, part_no, text``): all sheets in order; see ``ordered_text`` for parts."""
    return ordered_text(sheet_lines(cells, sheets, keys), keys, ["table_no", "row_no"], "line", "\n", "text", part_chars)


def text_doc_lines(blocks: DataFrame, cells: DataFrame, keys: Sequence[str] = ("doc",)) -> DataFrame:
    """Lines of text documents (``keys, block_no, row_no, line``).

    ``blocks`` holds every paragraph and heading in document order, those inside table cells
    too; ``cells`` holds ``keys, block_no, row_no, col_no, text`` with the position of the table.
    The paragraphs of cells so appear again after the rows of their table.
    """
    text = strip(F.coalesce(F.col("text"), F.lit("")))
    paragraphs = (
        blocks.select(*keys, "block_no", F.lit(-1).alias("row_no"), text.alias("line")).where(F.col("line") != "")
    )
    at = [*keys, "block_no"]
    rows = _rows(cells, at, text).select(*at, "row_no", _row_line(F.col("cells")).alias("line"))
    return paragraphs.unionByName(rows)


def text_docs_to_text(
    blocks: DataFrame, cells: DataFrame, keys: Sequence[str] = ("doc",), part_chars: int = PART_CHARS
) -> DataFrame:
    """Text of text documents (``keys, part_no, text``): all lines in order; see ``ordered_text`` for parts."""
    return ordered_text(text_doc_lines(blocks, cells, keys), keys, ["block_no", "row_no"], "line", "\n", "text", part_chars)
