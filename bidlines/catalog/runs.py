"""Sources, sinks and whole runs over notices that Spark writes from the orders.

Files go to a new path in the shared folder (``spark.checkpoint.dir``) on every call.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cascade import pending
from ..operators.quality import rejects
from ..plans.extract import MANIFEST, NOTICES, QUEUE, read_finished, run_batch
from ..schemas import ANSWERS, ITEM, PAGES, PROCESSED_NOTICE
from ..sources.files import open_root, read_file_index
from ..sources.layout import by_notice, write_by_notice
from ..sources.notices import explode_attachments, notice_header, read_notices
from ..sources.results import RUN, export_json, read_checkpoint, read_export, read_table, write_failures, write_manifest, write_results
from ..sources.shared import new_path
from ..streaming.incremental import run_incremental
from .registry import Tables, big, query, text
from .tables import customer_notices


def _order() -> tuple[Column, Column, Column]:
    """Order key, customer key and notice name."""
    key = F.col("o_orderkey")
    return key, F.col("o_custkey"), text(key, ".json")


def write_order_notices(t: Tables, which: str = "true") -> str:
    """One notice per order (or per order of a kind) as JSON lines; returns their folder. Some header fields are absent."""
    path = new_path(t.spark, "notices")
    key, cust, name = _order()
    notice = text(
        "Itens\r\n----------\r\n1 - ", F.col("o_orderpriority"), "\r\nQuantidade: ", cust % 9 + 1,
        "\r\nUnidade de fornecimento: Par\r\n----------\r\n2 - MESA MESA ", F.col("o_orderstatus"), "\r\nQuantidade: ", key % 5,
    )
    refs = F.array(
        F.struct(text("edital_", key % 7, ".pdf").alias("nome"), text("s3://l/", key, ".pdf").alias("caminho")),
        F.struct(F.lit("foto.png").alias("nome"), F.lit("s3://l/foto.png").alias("caminho")),
        F.struct(F.lit("termo.docx").alias("nome"), F.lit("s3://l/t.docx").alias("caminho")),
    )
    data = F.struct(
        text("PE/", key).alias("numero_pregao"),
        cust.alias("orgao"),
        F.when(key % 4 > 0, F.lit("Lapa")).alias("cidade"),
        F.when(key % 6 > 0, F.lit("pr")).alias("estado"),
        F.array(notice).alias("itens"),
        F.slice(refs, 1, (key % 4).cast("int")).alias("anexos"),
    )
    # JSON leaves out null fields, so they are absent in the file.
    t.orders.where(which).select(name.alias("arquivo_json"), F.lit("editais").alias("type"), data.alias("data")).write.json(path)
    return path


@query(
    """
    SELECT o_orderkey || '.json' AS arquivo_json, 'PE/' || o_orderkey AS numero_pregao, CAST(o_custkey AS VARCHAR) AS orgao,
           CASE WHEN o_orderkey % 4 > 0 THEN 'Lapa' ELSE '' END AS cidade, CASE WHEN o_orderkey % 6 > 0 THEN 'PR' ELSE '' END AS estado,
           CAST(1 AS BIGINT) AS textos, CAST(0 AS BIGINT) AS motivos
    FROM orders
    """
)
def notice_scan(t: Tables) -> DataFrame:
    """SC1, SC2 on bundled notices."""
    header = notice_header(read_notices(t.spark, write_order_notices(t), bundled=True))
    return header.select(
        "arquivo_json", "numero_pregao", "orgao", "cidade", "estado",
        big(F.size("itens")).alias("textos"), big(F.size("ilegivel")).alias("motivos"),
    )


@query(
    """
    SELECT o_orderkey || '.json' AS arquivo_json, CAST(i AS BIGINT) AS att_pos, CAST(o_orderkey AS VARCHAR) AS folder,
           CASE i WHEN 0 THEN 'edital_' || o_orderkey % 7 || '.pdf' WHEN 1 THEN 'foto.png' ELSE 'termo.docx' END AS nome
    FROM (SELECT *, unnest(range(o_orderkey % 4)) AS i FROM orders)
    """
)
def attachment_refs(t: Tables) -> DataFrame:
    """SC3."""
    refs = explode_attachments(read_notices(t.spark, write_order_notices(t), bundled=True))
    return refs.select("arquivo_json", big("att_pos").alias("att_pos"), "folder", "nome")


def _folder_writer(root: str):
    """Writes the lines of each ``s``, rows of which come one after the other, as one file in a folder ``s=...`` under ``root``.

    Spark's own writer starts a process or two for every folder and file of a local disk, and its driver moves them one by one.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_root(root)
        done, now, out = 0, None, None
        for batch in batches:
            for s, group in batch.groupby(batch["s"].fillna("__HIVE_DEFAULT_PARTITION__"), sort=False):
                if s != now:
                    if out is not None:
                        out.close()
                    system.create_dir(f"{base}/s={s}")
                    now, out, done = s, system.open_output_stream(f"{base}/s={s}/part-0.txt"), done + 1
                out.write("".join(f"{line}\n" for line in group["s_name"].fillna("")).encode())
        if out is not None:
            out.close()
        yield pd.DataFrame({"folders": [done]})

    return write


@query(
    """
    SELECT 's=' || s_suppkey AS folder, CAST(length(s_name) + 1 AS BIGINT) AS length FROM supplier
    """
)
def file_index(t: Tables) -> DataFrame:
    """SC4: one folder with one file per supplier, written by tasks; sizes are compared."""
    path = new_path(t.spark, "files")
    lines = t.supplier.select(text(F.col("s_suppkey")).alias("s"), "s_name").repartition(4 * t.spark.sparkContext.defaultParallelism, "s").sortWithinPartitions("s")
    system, base = open_root(path)
    system.create_dir(base)
    lines.mapInPandas(_folder_writer(path), "folders bigint").write.format("noop").mode("overwrite").save()
    return read_file_index(t.spark, path).where(F.col("file_name").startswith("part-")).select("folder", "length")


# --- whole runs ------------------------------------------------------------------------------

RUN_SQL = """
    WITH base AS (
      SELECT *, o_orderkey || '.json' AS arquivo_json, o_orderkey % 4 >= 1 AS com_pdf, o_orderkey % 4 = 3 AS com_docx FROM orders
      WHERE o_orderkey % 6 > 0)
    , solved AS (
      SELECT *, CASE WHEN com_pdf AND o_orderkey % 5 < 2 THEN 1 WHEN com_docx AND o_orderkey % 3 > 0 THEN 2 ELSE 3 END AS tier FROM base)
    SELECT arquivo_json, 'G1' AS lote, CAST(1 AS BIGINT) AS item, 'MATERIAL ' || o_orderstatus AS objeto,
           CAST(o_custkey % 50 + 1 AS BIGINT) AS quantidade, 'Caixa' AS unidade_fornecimento FROM solved WHERE tier = 1
    UNION ALL
    SELECT arquivo_json, NULL, CAST(7 AS BIGINT), 'peca ' || o_custkey, CAST(2 AS BIGINT), 'UN' FROM solved WHERE tier = 2
    UNION ALL
    SELECT arquivo_json, NULL, CAST(1 AS BIGINT), o_orderpriority, CAST(o_custkey % 9 + 1 AS BIGINT), 'Par' FROM solved WHERE tier = 3
    UNION ALL
    SELECT arquivo_json, NULL, CAST(2 AS BIGINT), 'MESA ' || o_orderstatus, CAST(o_orderkey % 5 AS BIGINT), 'Unidade'
    FROM solved WHERE tier = 3 AND o_orderkey % 5 > 0
"""


def run_inputs(t: Tables) -> dict[str, DataFrame]:
    """File index, page texts and model answers for the order notices."""
    key, cust, name = _order()
    files = t.orders.select(
        key.cast("string").alias("folder"),
        F.explode(F.array(text("edital_", key % 7, ".pdf"), F.lit("x-termo.docx"))).alias("file_name"),
    ).select("folder", "file_name", F.concat_ws("/", "folder", "file_name").alias("path"), F.lit(9).cast("bigint").alias("length"))
    pages = F.array(
        F.lit("Composição dos Grupos\nG1\nItem 1"),
        text("1 - MATERIAL\n", F.col("o_orderstatus"), "\nQuantidade Total: ", cust % 50 + 1),
        F.lit("Unidade de Fornecimento: Caixa\n"),
    )
    paged = t.orders.where(key % 5 < 2).select(
        name.alias("arquivo_json"), F.lit(0).alias("att_pos"), F.posexplode(pages).alias("n", "text")
    )
    answer = text('[{"item": 7, "objeto": "peca ', cust, '", "quantidade": 2, "unidade_fornecimento": "UN"}]')
    raw = F.array(F.lit("sem resposta"), F.when(key % 3 > 0, answer).otherwise(F.lit("[]")))
    answers = t.orders.select(name.alias("arquivo_json"), F.posexplode(raw).alias("n", "raw"))
    return {
        "files": files,
        "pages": paged.select("arquivo_json", "att_pos", (F.col("n") + 1).alias("page_no"), "text"),
        "answers": answers.select("arquivo_json", (F.col("n") * 2).alias("att_pos"), "raw"),
    }


def _items_written(t: Tables, out: str) -> DataFrame:
    results = read_finished(t.spark, out, NOTICES, PROCESSED_NOTICE)
    return results.select("arquivo_json", F.inline("itens_extraidos"))


@query(RUN_SQL)
def batch_run(t: Tables) -> DataFrame:
    """SC5, SC6, WI3 and the operators before it, as one run that is then resumed with nothing left to do."""
    notices, out = write_order_notices(t), new_path(t.spark, "out")
    for run in ("r1", "r2"):
        run_batch(t.spark, notices, "downloads", out=out, run=run, bundled=True, **run_inputs(t))
    return _items_written(t, out)


@query(RUN_SQL)
def incremental_run(t: Tables) -> DataFrame:
    """ST1: the same as a stream of files, with pages and answers laid out by notice."""
    notices, out, ckpt = write_order_notices(t), new_path(t.spark, "out"), new_path(t.spark, "stream")
    inputs = run_inputs(t)
    for name, schema in (("pages", PAGES), ("answers", ANSWERS)):
        path = new_path(t.spark, name)
        write_by_notice(inputs[name], path, buckets=8)
        inputs[name] = by_notice(t.spark, path, schema, buckets=8)
    run_incremental(t.spark, notices, None, out=out, checkpoint=ckpt, bundled=True, **inputs).awaitTermination()
    return _items_written(t, out)


@query(
    """
    WITH base AS (SELECT *, o_orderkey || '.json' AS arquivo_json FROM orders WHERE o_orderkey % 6 > 0)
    SELECT arquivo_json, 1 AS item, 'MATERIAL ' || o_orderstatus AS objeto FROM base WHERE o_orderkey % 4 >= 1 AND o_orderkey % 5 < 2
    UNION ALL
    SELECT arquivo_json, 10 + i, 'linha ' || i || ' de ' || o_custkey FROM base, range(3) AS r(i)
    WHERE o_orderkey % 4 = 3 AND o_orderkey % 5 >= 2 AND o_orderkey % 10 <> 7
    UNION ALL
    SELECT arquivo_json, 1, o_orderpriority FROM base WHERE NOT (o_orderkey % 4 >= 1 AND o_orderkey % 5 < 2) AND o_orderkey % 4 < 3
    UNION ALL
    SELECT arquivo_json, 2, 'MESA ' || o_orderstatus FROM base WHERE NOT (o_orderkey % 4 >= 1 AND o_orderkey % 5 < 2) AND o_orderkey % 4 < 3 AND o_orderkey % 5 > 0
    """
)
def rescue_run(t: Tables) -> DataFrame:
    """FI9, IT7, WI2 in a run: the first run writes the queue, its pieces are answered, the second takes the answers by piece.

    Texts have three lines and a piece takes one; every tenth text is left unanswered in one piece, so its notice waits.
    """
    key, cust, name = _order()
    inputs = run_inputs(t)
    three = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: text("linha ", i, " de ", cust)), "\n")
    texts = t.orders.select(name.alias("arquivo_json"), F.lit(2).alias("att_pos"), three.alias("text"))
    nothing = t.spark.createDataFrame([], "arquivo_json string, att_pos int, trecho bigint, raw string")
    notices, out = write_order_notices(t), new_path(t.spark, "out")

    def go(run: str, answers: DataFrame) -> None:
        run_batch(t.spark, notices, "downloads", inputs["pages"], answers, out, run, bundled=True, files=inputs["files"], texts=texts, piece_chars=21)

    go("r1", nothing)
    queue = t.spark.read.parquet(f"{out}/{QUEUE}")
    asked = queue.where(~(F.col("arquivo_json").endswith("7.json") & (F.col("trecho") == 1)))
    said = text('[{"item": ', F.col("trecho") + 10, ', "objeto": "', F.regexp_replace("text", "\\n", ""), '", "quantidade": 1, "unidade_fornecimento": "UN"}]')
    go("r2", asked.select("arquivo_json", "att_pos", "trecho", said.alias("raw")))
    return _items_written(t, out).select("arquivo_json", F.col("item").cast("int").alias("item"), "objeto")


@query(
    """
    SELECT o_orderkey || '.json' AS arquivo_json, count(*) AS itens FROM (SELECT o_orderkey, unnest(range(1 + (o_orderkey % 5 > 0)::INT)) FROM orders
      WHERE o_orderkey % 6 > 0) GROUP BY o_orderkey
    """
)
def replayed_run(t: Tables) -> DataFrame:
    """SC5, SE2: a run name used again on a folder that has lost half of its notices and got others; no result is lost."""
    first, second = (write_order_notices(t, which) for which in ("o_orderkey % 3 < 2", "o_orderkey % 3 > 0"))
    out = new_path(t.spark, "out")
    none = {name: df.limit(0) for name, df in run_inputs(t).items()}
    for path in (first, second, second):
        run_batch(t.spark, path, "downloads", out=out, run="r1", bundled=True, **none)
    return _items_written(t, out).groupBy("arquivo_json").agg(F.count("*").alias("itens"))


@query(
    """
    SELECT o_orderkey || '.json' AS arquivo_json, 'r2' AS execucao FROM orders WHERE o_orderkey % 6 > 0
    """
)
def void_checkpoint(t: Tables) -> DataFrame:
    """SC9: one invalid row among the results, and the next run does all notices again and drops what was there."""
    notices, out = write_order_notices(t), new_path(t.spark, "out")
    none = {name: df.limit(0) for name, df in run_inputs(t).items()}
    bad = t.orders.select(F.min("o_orderkey").alias("k")).select(
        text(F.col("k"), ".json").alias("arquivo_json"), F.lit("PE").alias("numero_pregao"), F.lit("o").alias("orgao"), F.lit("c").alias("cidade"),
        F.lit("pr").alias("estado"), F.array().cast("array<string>").alias("anexos_processados"), F.array().cast(f"array<{ITEM}>").alias("itens_extraidos"),
    )
    write_results(bad.withColumn("parte", F.lit(0).cast("bigint")), f"{out}/{NOTICES}", "r1")
    write_manifest(t.spark, f"{out}/{NOTICES}", f"{out}/{MANIFEST}", "r1")
    run_batch(t.spark, notices, "downloads", out=out, run="r2", bundled=True, **none)
    return read_table(t.spark, f"{out}/{NOTICES}", f"arquivo_json string, {RUN} string")


@query(
    """
    SELECT c_custkey AS arquivo_json FROM customer
    WHERE NOT (c_acctbal >= 0 AND c_custkey % 7 > 1
               AND len(list_filter([1, 2, 3], lambda i: i <= c_custkey % 4 AND (c_custkey + i) % 11 = 0)) = 0)
    """
)
def checkpoint_read(t: Tables) -> DataFrame:
    """SC9, SE2: results of valid notices are written and read back; the others are still pending."""
    path = new_path(t.spark, "results")
    notices = customer_notices(t).withColumn("arquivo_json", F.col("arquivo_json").cast("string"))
    refused = rejects(notices).select("arquivo_json")
    write_results(notices.join(refused, "arquivo_json", "left_anti"), path, "r1")
    return pending(notices.select("arquivo_json"), read_checkpoint(t.spark, path)).select(big("arquivo_json").alias("arquivo_json"))


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY c_name || c_custkey) - 1 AS BIGINT) AS pos, c_name || c_custkey AS arquivo_json FROM customer
    """
)
def ordered_export(t: Tables) -> DataFrame:
    """SO1: results exported as JSON lines by file name and read back in the order of their files."""
    path = new_path(t.spark, "export")
    notices = t.customer.select(text(F.col("c_name"), F.col("c_custkey")).alias("arquivo_json"), F.lit(None).cast("string").alias("orgao"))
    export_json(notices, path)
    return read_export(t.spark, path, "arquivo_json string, orgao string").select("pos", "arquivo_json")


@query(
    """
    SELECT user_id || '.json' AS arquivo_json, 'anexo_' || event_id AS anexo, 'r3' AS execucao FROM events WHERE event_type = 'error'
    """
)
def reset_run(t: Tables) -> DataFrame:
    """SC6, SC8: failures of two runs are dropped by a third that starts anew."""
    path = new_path(t.spark, "failures")
    failures = t.events.select(
        text(F.col("user_id"), ".json").alias("arquivo_json"), text("anexo_", F.col("event_id")).alias("anexo"),
        F.col("props").alias("motivo"), "event_type",
    )
    write_failures(failures.where("event_type = 'view'"), path, "r1")
    write_failures(failures.where("event_type = 'click'"), path, "r2")
    write_failures(failures.where("event_type = 'error'"), path, "r3", reset=True)
    return read_table(t.spark, path, f"arquivo_json string, anexo string, {RUN} string")
