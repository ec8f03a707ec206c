"""The scoring plan: validity of a result table and accuracy against an answer set."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ..operators.quality import rejects, validation_summary
from ..operators.scoring import accuracy_summary, align_items, compare_items, flat_rows, item_rows, last_answers


class Evaluation(NamedTuple):
    summary: DataFrame
    rejects: DataFrame
    compared: DataFrame | None
    accuracy: DataFrame | None


def evaluate(pred: DataFrame, gold: DataFrame | None = None) -> Evaluation:
    """``pred`` holds nested result rows, ``gold`` the same with their file order in ``pos``.

    Rows of either may be parts of notices, told apart by ``parte``.
    """
    compared = accuracy = None
    if gold is not None:
        kept = [c for c in ("arquivo_json", "itens_extraidos", "pos", "parte") if c in gold.columns]
        compared = compare_items(align_items(item_rows(pred), item_rows(last_answers(gold.select(*kept)))))
        accuracy = accuracy_summary(compared)
    return Evaluation(validation_summary(pred), rejects(pred), compared, accuracy)


def evaluate_items(pred: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comparison and accuracy of flat items (``arquivo_json, att_pos, block_pos`` and item fields); nothing is nested."""
    compared = compare_items(align_items(flat_rows(pred), flat_rows(gold)))
    return compared, accuracy_summary(compared)
