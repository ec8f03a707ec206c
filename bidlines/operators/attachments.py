"""Which file an attachment reference means, and what went wrong with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.names import base_name, file_stem, is_relevant_attachment
from ..sources.shared import cut_lineage, keyed

REF = ("arquivo_json", "att_pos")
#: Characters of a gram that file names are indexed by.
GRAM = 3


def relevant_attachments(refs: DataFrame) -> DataFrame:
    """References worth opening, by name."""
    return refs.where(is_relevant_attachment(F.col("nome")))


def _by_exact_name(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Rank 1: base name of ``caminho``; rank 2: ``nome``. Both are equality on folder and name."""
    wanted = F.array(
        F.struct(F.lit(1).alias("rank"), base_name(F.col("caminho")).alias("file_name")),
        F.struct(F.lit(2).alias("rank"), F.col("nome").alias("file_name")),
    )
    asked = refs.select(*REF, "folder", F.inline(wanted)).where(F.col("file_name") != "")
    found = asked.join(keyed(files), ["folder", "file_name"])
    return found.groupBy(*REF).agg(F.min(F.struct("rank", "file_name", "path", "length")).alias("file"))


def grams(c: Column, size: int = GRAM) -> Column:
    """The different substrings of ``size`` characters of a text; none of a shorter one."""
    starts = F.when(F.length(c) >= size, F.sequence(F.lit(1), F.length(c) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda at: F.substr(c, at, F.lit(size))))


def _by_stem(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Rank 3: first file by name whose lower-case name holds the lower-case stem of ``nome``.

    (A name equal but for case holds the stem too, so that needs no test of its own.)
    A folder's file names are indexed by their grams, of which only those that a stem asks for
    are kept. A stem is looked up under its rarest gram alone, not at all if one of its grams is in
    no name of the folder, and the names found are tested. Stems too short for a gram stand
    under the empty one, as all names do. Each wanted stem keeps one file before references come in.
    """
    stem = F.lower(file_stem(F.col("nome")))
    asked = refs.select(*REF, "folder", stem.alias("stem")).where(F.col("stem") != "")
    wanted = F.when(F.length("stem") < GRAM, F.array(F.lit(""))).otherwise(grams(F.col("stem")))
    stems = cut_lineage(asked.select("folder", "stem").distinct()).select("folder", "stem", F.size(wanted).alias("n"), F.explode(wanted).alias("gram"))
    low = F.lower(F.col("file_name"))
    index = files.join(keyed(stems.select("folder").distinct()), "folder", "left_semi").select("folder", "file_name", "path", "length", low.alias("low"), F.explode(F.concat(grams(low), F.array(F.lit("")))).alias("gram"))
    index = cut_lineage(index.join(keyed(stems.select("folder", "gram").distinct()), ["folder", "gram"], "left_semi"))
    counts = index.groupBy("folder", "gram").agg(F.count(F.lit(1)).alias("files"))
    rarest = (
        stems.join(keyed(counts), ["folder", "gram"])
        .groupBy("folder", "stem", "n")
        .agg(F.count(F.lit(1)).alias("found"), F.min(F.struct("files", "gram")).alias("rarest"))
        .where("found = n")
        .select("folder", "stem", F.col("rarest.gram").alias("gram"))
    )
    best = (
        index.join(keyed(rarest), ["folder", "gram"])
        .where(F.contains("low", "stem"))
        .groupBy("folder", "stem")
        .agg(F.min(F.struct(F.lit(3).alias("rank"), "file_name", "path", "length")).alias("file"))
    )
    return asked.join(keyed(best), ["folder", "stem"]).select(*REF, "file")


def resolve_attachments(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References with ``rank, file_name, path, length`` of the file they mean; null if none.

    ``pasta_existe`` tells whether the folder of an unresolved reference holds any file.
    """
    files = files.select("folder", "file_name", "path", "length")
    exact = cut_lineage(_by_exact_name(refs, files))
    open_refs = refs.join(keyed(exact), list(REF), "left_anti")
    by_stem = _by_stem(open_refs, files)
    found = exact.unionByName(by_stem)
    folders = files.select("folder").distinct().withColumn("pasta_existe", F.lit(True))
    return (
        refs.join(keyed(found), list(REF), "left")
        .join(keyed(folders), "folder", "left")
        .select(
            *refs.columns,
            "file.rank",
            "file.file_name",
            "file.path",
            "file.length",
            F.coalesce("pasta_existe", F.lit(False)).alias("pasta_existe"),
        )
    )


def usable(resolved: DataFrame) -> DataFrame:
    """Resolved references whose file is not empty."""
    return resolved.where(F.col("length") > 0)


def attachment_failures(resolved: DataFrame, root: str = "downloads") -> DataFrame:
    """``arquivo_json, att_pos, anexo, motivo`` for missing folders, missing files and empty files."""
    folder = F.concat(F.lit(root.rstrip("/") + "/"), F.col("folder"))
    reason = (
        F.when(~F.col("pasta_existe"), F.concat(F.lit(P.REASON_NO_FOLDER), folder))
        .when(
            F.col("file_name").isNull(),
            F.concat(F.lit(P.REASON_NO_FILE[0]), F.col("nome"), F.lit(P.REASON_NO_FILE[1]), folder),
        )
        .when(F.col("length") == 0, F.concat(F.lit(P.REASON_EMPTY_FILE), F.col("file_name")))
    )
    return resolved.select(*REF, F.col("nome").alias("anexo"), reason.alias("motivo")).where("motivo IS NOT NULL")


def split_ok_failed(resolved: DataFrame, root: str = "downloads") -> tuple[DataFrame, DataFrame]:
    """The usable references and the failure rows."""
    return usable(resolved), attachment_failures(resolved, root)


def processed_attachments(resolved: DataFrame) -> DataFrame:
    """Names of the usable attachments per notice, in order, whether or not they gave items.

    A list is no longer than the reference array of its notice, which came in as one row.
    """
    return (
        usable(resolved)
        .groupBy("arquivo_json")
        .agg(F.array_sort(F.collect_list(F.struct("att_pos", "nome"))).alias("refs"))
        .select("arquivo_json", F.col("refs.nome").alias("anexos_processados"))
    )
