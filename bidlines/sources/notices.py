"""Notice files: scan, header, attachment references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_stem
from ..schemas import ATTACHMENT_REF, NOTICE_SCHEMA

_CORRUPT = "_corrupt"
REASON_BAD_JSON = "arquivo: JSON inválido"
REASON_NULL_REFS = "anexos: nulo"
REASON_BAD_REFS = "anexos: inválido"
REASON_NULL_NAME = "anexos.nome: nulo"


def notice_schema(bundled: bool = False) -> str:
    name = "arquivo_json string," if bundled else ""
    return f"{name} {NOTICE_SCHEMA}, {_CORRUPT} string"


def _named(df: DataFrame, bundled: bool) -> DataFrame:
    name = F.col("arquivo_json") if bundled else F.col("_metadata.file_name")
    return df.select(name.alias("arquivo_json"), "data", _CORRUPT)


def _reader_options(bundled: bool) -> dict[str, str]:
    return {
        "multiLine": "false" if bundled else "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "pathGlobFilter": "*.json",
    }


def read_notices(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """One row per notice, with its file name as ``arquivo_json``.

    A folder holds one JSON file per notice. ``bundled`` reads JSON lines instead, where each
    line also names its ``arquivo_json``: the form for large sets, as it splits and lists well.
    A file that is no JSON stays as a row and becomes a reject.
    """
    reader = spark.read.schema(notice_schema(bundled)).options(**_reader_options(bundled))
    return _named(reader.json(path), bundled)


def stream_notices(
    spark: SparkSession, path: str, bundled: bool = False, max_files_per_trigger: int = 10_000
) -> DataFrame:
    """``read_notices`` as a stream of new files."""
    reader = spark.readStream.schema(notice_schema(bundled)).options(**_reader_options(bundled))
    return _named(reader.option("maxFilesPerTrigger", max_files_per_trigger).json(path), bundled)


def _header_text(v: Column) -> Column:
    """Absent is '', JSON null is the word None, anything else is its text."""
    return (
        F.when(v.isNull(), F.lit(""))
        .when(F.is_variant_null(v), F.lit("None"))
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    )


def _refs() -> Column:
    return F.try_variant_get(F.col("data.anexos"), "$", ATTACHMENT_REF)


def _malformed_refs() -> Column:
    """References that are no list of objects; an empty text or object counts as an empty list."""
    refs = F.col("data.anexos")
    each = F.try_variant_get(refs, "$", "array<variant>")
    odd = F.exists(each, lambda a: a.isNull() | F.try_variant_get(a, "$", "map<string,variant>").isNull())
    none = F.to_json(refs).isin("{}", '""')
    return F.when(refs.isNull() | F.is_variant_null(refs) | none, F.lit(False)).otherwise(F.coalesce(odd, F.lit(True)))


def unreadable_reasons() -> Column:
    """Why a notice cannot be processed at all; empty for a readable one."""
    null_refs = F.coalesce(F.is_variant_null("data.anexos"), F.lit(False))
    null_name = F.coalesce(F.exists(_refs(), lambda a: F.is_variant_null(a["nome"])), F.lit(False))
    return F.array_compact(
        F.array(
            F.when(F.col(_CORRUPT).isNotNull(), F.lit(REASON_BAD_JSON)),
            F.when(null_refs, F.lit(REASON_NULL_REFS)),
            F.when(_malformed_refs(), F.lit(REASON_BAD_REFS)),
            F.when(null_name, F.lit(REASON_NULL_NAME)),
        )
    )


def notice_header(df: DataFrame) -> DataFrame:
    """Header fields with defaults, upper-case ``estado``, the item texts and ``ilegivel`` reasons."""
    return df.select(
        "arquivo_json",
        _header_text(F.col("data.numero_pregao")).alias("numero_pregao"),
        _header_text(F.col("data.orgao")).alias("orgao"),
        _header_text(F.col("data.cidade")).alias("cidade"),
        F.upper(_header_text(F.col("data.estado"))).alias("estado"),
        F.col("data.itens").alias("itens"),
        unreadable_reasons().alias("ilegivel"),
    )


def explode_attachments(df: DataFrame) -> DataFrame:
    """One row per attachment reference, with its position and the folder of its notice."""
    return df.select("arquivo_json", F.posexplode(_refs()).alias("att_pos", "ref")).select(
        "arquivo_json",
        "att_pos",
        file_stem(F.col("arquivo_json")).alias("folder"),
        F.coalesce(F.try_variant_get("ref.nome", "$", "string"), F.lit("")).alias("nome"),
        *[F.col(f"ref.{c}").alias(c) for c in ("caminho", "formato", "url", "hash_content", "caminho_json")],
    )
