"""Scoring of results against an answer set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import percentage, strip, text_similarity
from ..schemas import ITEM_FIELDS
from .ordered import dense_positions

MATCHES = ("item", "quantidade", "lote", "objeto", "unidade_fornecimento")


def dedupe_last(df: DataFrame, keys: Sequence[str] = ("arquivo_json",), pos: str = "pos") -> DataFrame:
    """The last row per key by ``pos``. Merged map-side, so a key of any size is one row per task."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), pos).alias("_row"))
    return last.select(*keys, "_row.*")


def last_answers(df: DataFrame, key: str = "arquivo_json", pos: str = "pos") -> DataFrame:
    """The answer of each key that stands last by ``pos``, with all of its parts if answers come in parts."""
    if "parte" not in df.columns:
        return dedupe_last(df, [key], pos)
    last = df.groupBy(key).agg(F.max(pos).alias(pos))
    return df.join(last, [key, pos], "left_semi")


def item_rows(df: DataFrame) -> DataFrame:
    """Nested result rows as ``arquivo_json, pos`` and item fields; ``pos`` goes on from part to part.

    Where the rows have a ``parte``, the sizes of the earlier parts of a notice are added up; no
    items are moved for that.
    """
    start = F.lit(0).cast("bigint")
    if "parte" in df.columns:
        at = ["arquivo_json", "parte"]
        before = Window.partitionBy("arquivo_json").orderBy("parte").rowsBetween(Window.unboundedPreceding, -1)
        sizes = df.select(*at, F.coalesce(F.size("itens_extraidos"), F.lit(0)).alias("n"))
        starts = sizes.select(*at, F.coalesce(F.sum("n").over(before), start).alias("_start"))
        df, start = df.join(starts, at), F.col("_start")
    return df.select("arquivo_json", start.alias("_start"), F.posexplode("itens_extraidos").alias("n", "i")).select(
        "arquivo_json", (F.col("_start") + F.col("n")).alias("pos"), *[F.col(f"i.{c}").alias(c) for c in ITEM_FIELDS]
    )


def flat_rows(items: DataFrame) -> DataFrame:
    """Flat items of a run as ``arquivo_json, pos`` and item fields, numbered along ``att_pos, block_pos``."""
    fields = items.select("arquivo_json", "att_pos", "block_pos", *ITEM_FIELDS)
    placed = dense_positions(fields, ["arquivo_json"], ["att_pos", "block_pos", *ITEM_FIELDS])
    return placed.select("arquivo_json", "pos", *ITEM_FIELDS)


def align_items(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Predicted and expected items at the same position of the same file: ``pred``, ``gold`` structs.

    Both sides are flat: ``arquivo_json, pos`` and item fields. Items beyond the shorter list drop out.
    """
    sides = [
        rows.select("arquivo_json", "pos", F.struct(*ITEM_FIELDS).alias(name))
        for rows, name in ((pred, "pred"), (gold, "gold"))
    ]
    return sides[0].join(sides[1], ["arquivo_json", "pos"])


def _match(name: str) -> Column:
    p, g = F.col(f"pred.{name}"), F.col(f"gold.{name}")
    if name in ("item", "quantidade"):
        return F.coalesce(p.try_cast("bigint") == g.try_cast("bigint"), F.lit(False))
    if name == "lote":
        return strip(p).eqNullSafe(strip(g))
    p, g = (F.coalesce(c, F.lit("None")) for c in (p, g))
    if name == "objeto":
        return text_similarity(p, g) >= P.SIMILARITY_PASS
    return F.lower(strip(p)) == F.lower(strip(g))


def compare_items(aligned: DataFrame) -> DataFrame:
    """Adds a boolean ``ok_<field>`` per field and ``ok_todos``."""
    checked = aligned.withColumns({f"ok_{name}": _match(name) for name in MATCHES})
    every = F.lit(True)
    for name in MATCHES:
        every = every & F.col(f"ok_{name}")
    return checked.withColumn("ok_todos", every)


def accuracy_summary(compared: DataFrame) -> DataFrame:
    """``campo, acertos, comparados, pct``: all fields together (``todos``), then each field."""
    names = ("todos", *MATCHES)
    totals = compared.agg(
        F.count(F.lit(1)).alias("comparados"), *[F.count_if(f"ok_{name}").alias(name) for name in names]
    )
    return totals.unpivot("comparados", list(names), "campo", "acertos").select(
        "campo", "acertos", "comparados", percentage(F.col("acertos"), F.col("comparados")).alias("pct")
    )
