"""Texts that go to a model in pieces, and the answers put back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import strip
from ..sources.shared import keyed
from .answers import parse_rescue_answers
from .cascade import first_nonempty, unsolved

PIECE = "trecho"
#: Bits of a piece number that count pieces inside a part of a text, and of an item's place that count items of an answer.
PIECE_BITS, ITEM_BITS = 24, 20


def cut_text(c: Column, size: int) -> Column:
    """A text as an array of pieces of at most ``size`` characters; one behind the other they are the text.

    A piece ends with the last line that ends within its size, or at the size if no line does; what
    fits into one piece is not cut further. Empty and null texts have no pieces.
    """
    pattern = rf"(?s:.{{1,{size}}})\z|(?s:.{{0,{size - 1}}})\n|(?s:.{{1,{size}}})"
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def rescue_pieces(texts: DataFrame, size: int = P.RESCUE_CHARS, text: str = "text") -> DataFrame:
    """All pieces of all texts that are not blank: the other columns, ``trecho`` and ``text``.

    ``trecho`` orders the pieces of a text. Texts in parts (``part_no``) are cut part by part.
    """
    part = F.col("part_no").cast("bigint") if "part_no" in texts.columns else F.lit(0).cast("bigint")
    rest = [c for c in texts.columns if c not in (text, "part_no")]
    cut = texts.where(strip(F.col(text)) != "").select(*rest, part.alias("_part"), F.posexplode(cut_text(F.col(text), size)).alias("_n", text))
    return cut.select(*rest, (F.shiftleft("_part", PIECE_BITS) + F.col("_n")).alias(PIECE), text)


def rescue_queue(texts: DataFrame, *solved: DataFrame, size: int = P.RESCUE_CHARS) -> DataFrame:
    """The pieces of attachment texts whose notices have no items in any of ``solved``. No text is cut off."""
    return rescue_pieces(unsolved(texts, *solved), size)


def unanswered(queue: DataFrame, answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The pieces that have no answer row yet; an answer without content is an answer."""
    return queue.join(keyed(with_piece(answers).select(*keys, PIECE).distinct()), [*keys, PIECE], "left_anti")


def with_piece(answers: DataFrame) -> DataFrame:
    """Answers with the number of their piece; answers to whole texts are to piece 0."""
    if PIECE in answers.columns:
        return answers.withColumn(PIECE, F.coalesce(F.col(PIECE).cast("bigint"), F.lit(0)))
    return answers.withColumn(PIECE, F.lit(0).cast("bigint"))


def rescued_items(answers: DataFrame, keys: Sequence[str], keep=None) -> DataFrame:
    """Items of the first attachment of each notice whose answers, taken together, have any.

    The answers to the pieces of one attachment are one list, in the order of the pieces; a bad
    item voids the answer it stands in, not those to other pieces. The answers are parsed once.
    """
    parsed = parse_rescue_answers(with_piece(answers), [*keys, PIECE])
    placed = parsed.withColumn("block_pos", F.shiftleft(PIECE, ITEM_BITS) + F.col("block_pos")).drop(PIECE)
    return first_nonempty(placed, keep=keep)
