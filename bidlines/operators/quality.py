"""Validation of items and notices, rejects with reasons, and the validity summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percentage
from ..schemas import NOTICE_FIELDS


def valid_item(item: Column | None = None) -> Column:
    """Numbers present and at least 1, texts present; ``lote`` may be null. Never null itself.

    With no argument the item fields are columns of the frame, else fields of ``item``.
    """

    def field(name: str) -> Column:
        return F.col(name) if item is None else item[name]

    return (
        F.coalesce(field("item") >= 1, F.lit(False))
        & F.coalesce(field("quantidade") >= 1, F.lit(False))
        & field("objeto").isNotNull()
        & field("unidade_fornecimento").isNotNull()
    )


def _notice_checks() -> dict[str, Column]:
    checks = {f"{name}: ausente": F.col(name).isNotNull() for name in NOTICE_FIELDS}
    checks["estado: não são duas maiúsculas"] = F.coalesce(F.col("estado").rlike(r"\A[A-Z]{2}\z"), F.lit(True))
    return checks


def _item_check() -> Column:
    return F.coalesce(F.forall("itens_extraidos", valid_item), F.lit(True))


def reject_reasons(with_items: bool = True) -> Column:
    """Array of the reasons a notice row is refused; empty for a valid row."""
    checks = _notice_checks()
    if with_items:
        checks["itens_extraidos: item inválido"] = _item_check()
    return F.array_compact(F.array(*[F.when(~ok, F.lit(reason)) for reason, ok in checks.items()]))


def valid_notice(with_items: bool = True) -> Column:
    """True for a notice row that may be written."""
    ok = F.lit(True)
    for check in _notice_checks().values():
        ok = ok & check
    return ok & _item_check() if with_items else ok


def rejects(df: DataFrame, with_items: bool = True) -> DataFrame:
    """The refused notice rows with all their reasons."""
    return df.withColumn("motivos", reject_reasons(with_items)).where(F.size("motivos") > 0)


def validation_summary(df: DataFrame) -> DataFrame:
    """One row: notices, valid notices, their items and the items with a lot, and percentages.

    Items count only where their notice is valid. Rows with a ``parte`` are parts of notices: a
    notice counts once, and is valid if all its parts are.
    """
    items = F.coalesce(F.size("itens_extraidos"), F.lit(0))
    lots = F.coalesce(F.size(F.filter("itens_extraidos", lambda i: i["lote"].isNotNull())), F.lit(0))
    counted = df.select("arquivo_json", valid_notice().alias("ok"), items.alias("n"), lots.alias("n_lot"))
    if "parte" in df.columns:
        counted = counted.groupBy("arquivo_json").agg(F.min("ok").alias("ok"), F.sum("n").alias("n"), F.sum("n_lot").alias("n_lot"))
    counted = counted.agg(
        F.count(F.lit(1)).alias("licitacoes"),
        F.count_if("ok").alias("licitacoes_validas"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).cast("bigint").alias("itens"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n_lot"))), F.lit(0)).cast("bigint").alias("itens_com_lote"),
    )
    return counted.select(
        "*",
        percentage(F.col("licitacoes_validas"), F.col("licitacoes")).alias("pct_validas"),
        percentage(F.col("itens_com_lote"), F.col("itens")).alias("pct_com_lote"),
    )
