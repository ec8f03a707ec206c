"""Result, failure and answer tables: write, read back, report."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import dense_positions
from ..operators.quality import valid_notice
from ..schemas import PROCESSED_NOTICE
from .shared import cut_lineage, keyed


RUN = "execucao"


def write_results(df: DataFrame, path: str, run: str, reset: bool = False) -> None:
    """Write the rows of one run as parquet beside those of other runs.

    Writing a run again replaces it, so a retry leaves no row twice. ``reset`` also drops
    every other run.
    """
    (
        df.withColumn(RUN, F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if reset else "dynamic")
        .partitionBy(RUN)
        .parquet(path)
    )


def with_earlier_rows(df: DataFrame, path: str, run: str, again: DataFrame) -> DataFrame:
    """Rows to be written for a run, with those it wrote before about notices that are not done ``again``.

    The earlier rows are set aside first, as writing replaces the run's partition.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    earlier = read_table(df.sparkSession, path, f"{schema}, {RUN} string")
    if earlier is None:
        return df
    mine = earlier.where(F.col(RUN) == run).drop(RUN)
    return df.unionByName(cut_lineage(mine.join(keyed(again.select("arquivo_json")), "arquivo_json", "left_anti")))


def write_failures(df: DataFrame, path: str, run: str, reset: bool = False) -> None:
    """Write failure rows ``arquivo_json, anexo, motivo``, stamped with the time of writing."""
    stamped = df.select(F.current_timestamp().alias("ts"), "arquivo_json", "anexo", "motivo")
    write_results(stamped, path, run, reset)


def export_json(df: DataFrame, path: str, reset: bool = True) -> None:
    """Result rows as JSON lines, nulls written, in order by ``arquivo_json`` (and ``parte``).

    Rows are dealt out by range and the files are numbered in that order, so reading them one
    after the other (``read_export``) gives the whole order.
    """
    order = [c for c in ("arquivo_json", "parte") if c in df.columns]
    df.orderBy(*order).write.mode("overwrite" if reset else "append").option("ignoreNullFields", "false").json(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An export with ``pos``, the place of each row in it, by file and line."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    placed = dense_positions(lines, [], ["file", "block", "line"])
    return placed.select("pos", F.from_json("value", schema).alias("v")).select("pos", "v.*")


def failure_report_lines(df: DataFrame) -> DataFrame:
    """One text block of four lines (and a blank one) per failure row."""
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("- **Data/Hora:** "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        F.concat(F.lit("- **Arquivo JSON Origem:** "), F.col("arquivo_json")),
        F.concat(F.lit("- **Anexo Falho:** "), F.col("anexo")),
        F.concat(F.lit("- **Motivo:** "), F.col("motivo")),
        F.lit(""),
    )
    return df.select(block.alias("value"))


def write_failure_report(df: DataFrame, path: str) -> None:
    """The failure report as text files, in order of time."""
    failure_report_lines(df.orderBy("ts", "arquivo_json", "anexo")).write.mode("overwrite").text(path)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame | None:
    """A table written by earlier runs; null if there is none yet."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_manifest(spark: SparkSession, results: str, path: str, run: str, reset: bool = False) -> None:
    """What a run has done: ``arquivo_json, valido`` for each notice it wrote under ``results``, in one row.

    Written last, from what the run wrote and nothing older. A run without this has not ended.
    """
    written = spark.read.schema(f"{PROCESSED_NOTICE}, {RUN} string").parquet(results).where(F.col(RUN) == run)
    done = written.groupBy("arquivo_json").agg(F.min(valid_notice()).alias("valido"))
    write_results(done, path, run, reset)


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """``arquivo_json, execucao`` of all notices done; null if there is no manifest, no rows if one of them is invalid.

    That is what makes a checkpoint void, told from one small column instead of all results.
    """
    done = read_table(spark, path, f"arquivo_json string, valido boolean, {RUN} string")
    if done is None:
        return None
    valid = done.where("NOT valido").isEmpty()
    return done.select("arquivo_json", RUN) if valid else done.select("arquivo_json", RUN).limit(0)


def read_checkpoint(spark: SparkSession, path: str, fmt: str = "parquet", run_column: bool = False) -> DataFrame:
    """Previous results, or no rows at all if there are none or if any row is invalid.

    Looking for one invalid row stops at the first; only that answer comes to the driver.
    ``run_column`` adds the run that wrote each row.
    """
    schema = f"{PROCESSED_NOTICE}, {RUN} string" if run_column else PROCESSED_NOTICE
    previous = read_table(spark, path, schema, fmt)
    if previous is None or not previous.where(~valid_notice()).isEmpty():
        return spark.createDataFrame([], schema)
    return previous
