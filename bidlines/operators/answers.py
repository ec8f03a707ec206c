"""Model answers: JSON text in, items out. Narrow, no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import strip
from .quality import valid_item

_FENCE_START = rf"(?dm)^```(?:json)?{P.WS}*"
_FENCE_END = rf"(?dm){P.WS}*```$"
_WHOLE_NUMBER = rf"\A{P.WS}*([+-]?\d+)(?:\.0*)?{P.WS}*\z"


def strip_fences(c: Column) -> Column:
    """Answer text without Markdown code fences."""
    bare = strip(c)
    unfenced = strip(F.regexp_replace(F.regexp_replace(bare, _FENCE_START, ""), _FENCE_END, ""))
    return F.when(bare.contains("```"), unfenced).otherwise(bare)


_FIELDS = ("lote", "item", "objeto", "quantidade", "unidade_fornecimento")
_ITEMS = f"array<struct<{','.join(f'{name}:variant' for name in _FIELDS)}>>"


def _read(v: Column) -> Column:
    """Type and value of each field. An element that is no object has none."""
    kinds = [F.schema_of_variant(v[name]).alias(f"{name}_is") for name in _FIELDS]
    texts = [F.try_variant_get(v[name], "$", "string").alias(name) for name in ("lote", "objeto", "unidade_fornecimento")]
    return F.struct(*kinds, *texts, v["item"].alias("item"), v["quantidade"].alias("quantidade"))


def _text(v: Column, name: str) -> Column:
    """A JSON string; null for any other type."""
    return F.when(v[f"{name}_is"] == "STRING", v[name])


def _whole(v: Column, name: str) -> Column:
    """A whole number, also as text or with a zero fraction; true counts as 1. Plain numbers need no pattern."""
    kind = v[f"{name}_is"]
    # Null without a match, by one evaluation.
    digits = F.get(F.regexp_extract_all(F.try_variant_get(v[name], "$", "string"), F.lit(_WHOLE_NUMBER), F.lit(1)), F.lit(0))
    return (
        F.when(kind == "BIGINT", F.try_variant_get(v[name], "$", "bigint"))
        .when(kind == "BOOLEAN", F.try_variant_get(v[name], "$", "boolean").cast("bigint"))
        .otherwise(digits.try_cast("bigint"))
    )


def _item(v: Column) -> Column:
    return F.struct(
        _text(v, "lote").alias("lote"),
        _whole(v, "item").alias("item"),
        _text(v, "objeto").alias("objeto"),
        _whole(v, "quantidade").alias("quantidade"),
        _text(v, "unidade_fornecimento").alias("unidade_fornecimento"),
        F.coalesce(v["lote_is"].isin("VOID", "STRING"), F.lit(True)).alias("lote_ok"),
    )


def parse_rescue_answers(df: DataFrame, keys: Sequence[str], raw_col: str = "raw") -> DataFrame:
    """Items of the answers that are sound, in order.

    An answer is a list of items or an object with ``itens``; one bad item voids it all. Each
    step is a column of its own, and there is no filter before the last one: filters are pushed
    down, and an answer would be parsed again for each.
    """
    parsed = df.select(*keys, F.try_parse_json(strip_fences(F.col(raw_col))).alias("answer"))
    # A list has no field, and an object is no list.
    listed = F.coalesce(F.try_variant_get("answer", "$.itens", _ITEMS), F.try_variant_get("answer", "$", _ITEMS))
    # Types and values are read once, then combined: inside a lambda nothing is evaluated in common.
    items = parsed.select(*keys, F.transform(F.transform(listed, _read), _item).alias("items"))
    sound = F.forall("items", lambda i: valid_item(i) & F.coalesce(i["lote_ok"], F.lit(False)))
    kept = items.select(*keys, F.when(sound, F.col("items")).alias("items"))
    return kept.select(*keys, F.posexplode_outer("items").alias("block_pos", "i")).where("i IS NOT NULL").select(
        *keys,
        F.col("block_pos").cast("bigint").alias("block_pos"),
        "i.lote",
        "i.item",
        "i.objeto",
        "i.quantidade",
        "i.unidade_fornecimento",
    )
