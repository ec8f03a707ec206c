"""Attachments, cascade, validation, scoring, call log and rendering over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import attachments as A
from ..operators import cascade as C
from ..operators import rescue as R
from ..operators import nesting, quality, render, scoring
from ..operators.calls import rate_limit_streaks as streaks
from ..plans.evaluate import evaluate
from ..schemas import ITEM
from ..sources.results import failure_report_lines
from ..sources.shared import cut_lineage
from .items import CLASS_SQL, ERROR_SQL, ORDER_COLUMNS, call_error
from .registry import Tables, big, query, text

# --- attachments -------------------------------------------------------------------------


def file_index_of(t: Tables) -> DataFrame:
    """Files in one folder per supplier, named after line items; some are empty."""
    part, kind = F.col("l_partkey"), F.col("l_linenumber") % 4
    name = (
        F.when(kind == 0, text("x-edital_", part, ".pdf"))
        .when(kind == 1, text("Edital_", part, ".PDF"))
        .when(kind == 2, text("termo_", part, ".docx"))
        .otherwise(text("anexo_", part, "_v", F.col("l_linenumber"), ".pdf"))
    )
    folder = text("c", F.col("l_suppkey"))
    return (
        t.lineitem.select(folder.alias("folder"), name.alias("file_name"), (F.col("l_partkey") % 5).alias("length"))
        .distinct()
        .withColumn("path", F.concat_ws("/", "folder", "file_name"))
    )


def order_refs(t: Tables) -> DataFrame:
    """Two attachment references per order; some folders do not exist."""
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    refs = F.array(
        F.struct(
            text("edital_", order % 2000, ".pdf").alias("nome"),
            text("s3://lote/x-edital_", cust % 2000, ".pdf").alias("caminho"),
        ),
        F.struct(text("ANEXO_", order % 300, ".pdf").alias("nome"), F.lit(None).cast("string").alias("caminho")),
    )
    return t.orders.select(
        order.alias("arquivo_json"), text("c", cust % 120).alias("folder"), F.posexplode(refs).alias("att_pos", "r")
    ).select("arquivo_json", "att_pos", "folder", "r.nome", "r.caminho")


RESOLVED_SQL = """
    WITH files AS (
      SELECT DISTINCT 'c' || l_suppkey AS folder, l_partkey % 5 AS length,
             CASE l_linenumber % 4 WHEN 0 THEN 'x-edital_' || l_partkey || '.pdf' WHEN 1 THEN 'Edital_' || l_partkey || '.PDF'
               WHEN 2 THEN 'termo_' || l_partkey || '.docx' ELSE 'anexo_' || l_partkey || '_v' || l_linenumber || '.pdf' END AS file_name
      FROM lineitem)
    , refs AS (
      SELECT o_orderkey AS arquivo_json, 0 AS att_pos, 'c' || o_custkey % 120 AS folder, 'edital_' || o_orderkey % 2000 || '.pdf' AS nome,
             'x-edital_' || o_custkey % 2000 || '.pdf' AS alvo FROM orders
      UNION ALL
      SELECT o_orderkey, 1, 'c' || o_custkey % 120, 'ANEXO_' || o_orderkey % 300 || '.pdf', NULL FROM orders)
    , hits AS (
      SELECT arquivo_json, att_pos, file_name, length,
             CASE WHEN file_name = alvo THEN 1 WHEN file_name = nome THEN 2 ELSE 3 END AS rank
      FROM refs JOIN files USING (folder)
      WHERE file_name = alvo OR file_name = nome OR contains(lower(file_name), lower(replace(nome, '.pdf', ''))))
    , best AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arquivo_json, att_pos ORDER BY rank, file_name, length) AS rn FROM hits)
      WHERE rn = 1)
    , resolved AS (
      SELECT r.*, b.rank, b.file_name, b.length, r.folder IN (SELECT folder FROM files) AS existe
      FROM refs r LEFT JOIN best b USING (arquivo_json, att_pos))
"""


def _resolved(t: Tables) -> DataFrame:
    # Written once, as a run does: references and files are read three times.
    return A.resolve_attachments(cut_lineage(order_refs(t)), cut_lineage(file_index_of(t)))


@query(RESOLVED_SQL + "SELECT arquivo_json, CAST(att_pos AS BIGINT) AS att_pos, CAST(rank AS BIGINT) AS rank, file_name, length FROM resolved")
def resolved_attachments(t: Tables) -> DataFrame:
    """JO1, WI1."""
    return _resolved(t).select("arquivo_json", big("att_pos").alias("att_pos"), big("rank").alias("rank"), "file_name", "length")


@query(
    RESOLVED_SQL
    + """
    SELECT arquivo_json, CAST(att_pos AS BIGINT) AS att_pos, nome AS anexo,
           CASE WHEN NOT existe THEN 'Pasta de anexos não encontrada: downloads/' || folder
                WHEN file_name IS NULL THEN 'Arquivo anexo ''' || nome || ''' não foi encontrado em downloads/' || folder
                ELSE 'Arquivo corrompido ou vazio (0 bytes): ' || file_name END AS motivo
    FROM resolved WHERE file_name IS NULL OR length = 0
    """
)
def attachment_failures(t: Tables) -> DataFrame:
    """JO5, FI3."""
    failed = A.split_ok_failed(_resolved(t))[1]
    return failed.select("arquivo_json", big("att_pos").alias("att_pos"), "anexo", "motivo")


@query(
    RESOLVED_SQL
    + "SELECT arquivo_json, string_agg(nome, '|' ORDER BY att_pos) AS anexos FROM resolved WHERE length > 0 GROUP BY arquivo_json"
)
def processed_attachments(t: Tables) -> DataFrame:
    """AG4, SO2."""
    return A.processed_attachments(_resolved(t)).select(
        "arquivo_json", F.array_join("anexos_processados", "|").alias("anexos")
    )


# --- cascade -----------------------------------------------------------------------------


def _tiers(t: Tables) -> list[DataFrame]:
    line = t.lineitem.select(
        F.col("l_orderkey").alias("arquivo_json"), "l_linenumber", "l_partkey", big("l_quantity").alias("quantidade"), "l_returnflag"
    )
    return [line.where(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in "ANR"]


def _order_keys(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("arquivo_json"))


TIER_SQL = """
    WITH tiers AS (
      SELECT *, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS tier FROM lineitem)
    , kept AS (
      SELECT * FROM (SELECT *, min(tier) OVER (PARTITION BY l_orderkey) AS first FROM tiers) WHERE tier = first)
"""


@query(
    TIER_SQL
    + """SELECT l_orderkey AS arquivo_json, CAST(l_linenumber AS BIGINT) AS linha, l_partkey,
                CAST(l_quantity AS BIGINT) AS quantidade, CAST(tier AS BIGINT) AS tier FROM kept"""
)
def tier_cascade(t: Tables) -> DataFrame:
    """WI3, SE1."""
    return C.cascade(_order_keys(t), *_tiers(t)).select(
        "arquivo_json", big("l_linenumber").alias("linha"), "l_partkey", "quantidade", big("tier").alias("tier")
    )


@query(
    TIER_SQL
    + """
    , per_notice AS (SELECT l_orderkey, min(tier) AS tier, count(*) AS n FROM kept GROUP BY l_orderkey)
    , per_tier AS (
      SELECT coalesce(tier, 0) AS tier, count(*) AS licitacoes, coalesce(sum(n), 0) AS itens
      FROM orders LEFT JOIN per_notice ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT CAST(tier AS BIGINT) AS tier, CAST(licitacoes AS BIGINT) AS licitacoes, CAST(itens AS BIGINT) AS itens,
           round(100.0 * licitacoes / sum(licitacoes) OVER (), 6) AS pct FROM per_tier
    """
)
def tier_coverage(t: Tables) -> DataFrame:
    """AG7, SF7."""
    notices = _order_keys(t)
    covered = C.tier_coverage(C.cascade(notices, *_tiers(t)), notices)
    return covered.select(big("tier").alias("tier"), "licitacoes", "itens", F.round("pct", 6).alias("pct"))


@query(
    """
    SELECT conv_id, turn, md5(text) AS hash FROM conversations JOIN (
      SELECT conv_id, min(turn) AS turn FROM conversations WHERE role = 'assistant' AND contains(text, chr(10)) GROUP BY conv_id)
    USING (conv_id, turn)
    """
)
def first_nonempty_answer(t: Tables) -> DataFrame:
    """WI2: the first answer of a conversation that has more than one line."""
    filled = t.conversations.where((F.col("role") == "assistant") & F.col("text").contains("\n"))
    first = C.first_nonempty(filled.select("conv_id", "turn", "text"), ["conv_id"], "turn")
    return first.select("conv_id", "turn", F.md5("text").alias("hash"))


def pieces_sql(size: int) -> str:
    """Documents without a label, cut at the last line end within ``size`` characters."""
    return f"""
    WITH RECURSIVE cut AS (
      SELECT doc_id, -1 AS trecho, '' AS piece, text AS rest FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND regexp_matches(text, '\\S')
      UNION ALL
      SELECT doc_id, trecho + 1, substr(rest, 1, n), substr(rest, n + 1) FROM (
        SELECT doc_id, trecho, rest, CASE WHEN length(rest) <= {size} THEN {size} WHEN lines > 0 THEN lines ELSE {size} END AS n FROM (
          SELECT *, {size} - length(regexp_extract(substr(rest, 1, {size}), '[^\\n]*$')) AS lines FROM cut WHERE rest <> '')))
    SELECT doc_id AS arquivo_json, CAST(trecho AS BIGINT) AS trecho, md5(piece) AS hash, CAST(length(piece) AS BIGINT) AS chars FROM cut WHERE trecho >= 0
    """


def _pieces(t: Tables, size: int) -> DataFrame:
    texts = t.documents.select(F.col("doc_id").alias("arquivo_json"), "text")
    queue = R.rescue_queue(texts, t.labels.select(F.col("doc_id").alias("arquivo_json")), size=size)
    return queue.select("arquivo_json", "trecho", F.md5("text").alias("hash"), big(F.length("text")).alias("chars"))


@query(pieces_sql(120_000))
def rescue_queue(t: Tables) -> DataFrame:
    """FI9, IT7: documents without a label, whole, in pieces of the model's input limit."""
    return _pieces(t, 120_000)


@query(pieces_sql(1_500))
def rescue_pieces(t: Tables) -> DataFrame:
    """IT7: the same for a model that takes 1,500 characters, so that most documents have several pieces."""
    return _pieces(t, 1_500)


@query(
    """
    SELECT o_orderkey AS arquivo_json FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """
)
def pending_notices(t: Tables) -> DataFrame:
    """JO3, FI8."""
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("arquivo_json"))
    return C.pending(t.orders.select(F.col("o_orderkey").alias("arquivo_json")), done)


# --- validation and nesting ----------------------------------------------------------------


def customer_notices(t: Tables) -> DataFrame:
    """One result row per customer, some of them invalid, with 0 to 3 items."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    letter = F.chr(F.lit(65) + nation)
    estado = F.when(key % 7 == 0, F.lower(letter)).when(key % 7 == 1, text(letter, "A\n")).otherwise(text(letter, "A"))

    def item(i: Column) -> Column:
        return F.struct(
            F.when((key + i) % 3 == 0, text("G", i)).alias("lote"),
            big(i).alias("item"),
            text(F.col("c_mktsegment"), " ", i).alias("objeto"),
            big((key + i) % 11).alias("quantidade"),
            F.lit("UN").alias("unidade_fornecimento"),
        )

    items = F.filter(F.transform(F.sequence(F.lit(1), F.lit(3)), item), lambda i: i["item"] <= key % 4)
    return t.customer.select(
        key.alias("arquivo_json"),
        text("PE/", key).alias("numero_pregao"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("orgao"),
        text("N", nation).alias("cidade"),
        estado.alias("estado"),
        F.array().cast("array<string>").alias("anexos_processados"),
        items.cast(f"array<{ITEM}>").alias("itens_extraidos"),
    )


NOTICE_SQL = """
    WITH notices AS (
      SELECT c_custkey AS k, c_acctbal >= 0 AS tem_orgao,
             c_custkey % 7 > 1 AS estado_ok,
             list_filter([1, 2, 3], lambda i: i <= c_custkey % 4) AS i
      FROM customer)
    , checked AS (
      SELECT *, len(list_filter(i, lambda x: (k + x) % 11 = 0)) = 0 AS itens_ok,
             len(list_filter(i, lambda x: (k + x) % 3 = 0)) AS com_lote FROM notices)
"""


@query(
    NOTICE_SQL
    + """
    , marked AS (SELECT *, tem_orgao AND estado_ok AND itens_ok AS ok FROM checked)
    , totals AS (
      SELECT count(*) AS licitacoes, count(*) FILTER (ok) AS licitacoes_validas,
             coalesce(sum(len(i)) FILTER (ok), 0) AS itens, coalesce(sum(com_lote) FILTER (ok), 0) AS itens_com_lote FROM marked)
    SELECT CAST(licitacoes AS BIGINT) AS licitacoes, CAST(licitacoes_validas AS BIGINT) AS licitacoes_validas,
           CAST(itens AS BIGINT) AS itens, CAST(itens_com_lote AS BIGINT) AS itens_com_lote,
           round(100.0 * licitacoes_validas / licitacoes, 6) AS pct_validas, round(100.0 * itens_com_lote / itens, 6) AS pct_com_lote
    FROM totals
    """
)
def validation_summary(t: Tables) -> DataFrame:
    """AG1, VA1, VA2, SF7."""
    summary = quality.validation_summary(customer_notices(t))
    return summary.withColumns({c: F.round(c, 6) for c in ("pct_validas", "pct_com_lote")})


@query(
    NOTICE_SQL
    + """
    SELECT k AS arquivo_json, concat_ws('; ', CASE WHEN NOT tem_orgao THEN 'orgao: ausente' END,
             CASE WHEN NOT estado_ok THEN 'estado: não são duas maiúsculas' END,
             CASE WHEN NOT itens_ok THEN 'itens_extraidos: item inválido' END) AS motivos
    FROM checked WHERE NOT (tem_orgao AND estado_ok AND itens_ok)
    """
)
def rejects(t: Tables) -> DataFrame:
    """VA3."""
    return quality.rejects(customer_notices(t)).select("arquivo_json", F.array_join("motivos", "; ").alias("motivos"))


def _line_items(t: Tables, notice: str = "l_orderkey") -> DataFrame:
    return t.lineitem.select(
        F.col(notice).alias("arquivo_json"),
        F.col("l_linenumber").alias("att_pos"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("block_pos"),
        F.lit(None).cast("string").alias("lote"),
        F.col("l_partkey").alias("item"),
        F.lit("o").alias("objeto"),
        big("l_quantity").alias("quantidade"),
        F.lit("u").alias("unidade_fornecimento"),
    )


def _items_text() -> Column:
    return F.array_join(F.transform("itens_extraidos", lambda i: text(i["item"], "x", i["quantidade"])), ",").alias("itens")


@query(
    """
    SELECT l_orderkey AS arquivo_json, CAST(0 AS BIGINT) AS parte,
           string_agg(l_partkey || 'x' || CAST(l_quantity AS BIGINT), ',' ORDER BY l_linenumber, l_partkey * 1000000 + l_suppkey, CAST(l_quantity AS BIGINT)) AS itens
    FROM lineitem GROUP BY l_orderkey
    """
)
def nested_items(t: Tables) -> DataFrame:
    """AG3."""
    return nesting.nest_items(_line_items(t)).select("arquivo_json", "parte", _items_text())


@query(
    """
    WITH placed AS (
      SELECT l_suppkey, l_partkey || 'x' || CAST(l_quantity AS BIGINT) AS t,
             row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber, l_partkey * 1000000 + l_suppkey, l_partkey, CAST(l_quantity AS BIGINT)) - 1 AS pos
      FROM lineitem)
    SELECT l_suppkey AS arquivo_json, CAST(pos // 50 AS BIGINT) AS parte, string_agg(t, ',' ORDER BY pos) AS itens FROM placed GROUP BY l_suppkey, pos // 50
    """
)
def nested_items_in_parts(t: Tables) -> DataFrame:
    """AG3 where notices of hundreds of items, one per supplier, come in parts of fifty."""
    items = _line_items(t, "l_suppkey")
    return nesting.nest_items(items, part_rows=50).select("arquivo_json", "parte", _items_text())


# --- scoring ---------------------------------------------------------------------------------


def _order_list(t: Tables, size: Column, gold: bool) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def item(i: Column) -> Column:
        name = text("MATERIAL ", F.col("o_orderpriority"), " TIPO ", cust % 50, " ", F.col("o_orderstatus"), " PARTE ", i)
        if gold:
            lote, objeto, quantity, unit = text("G", i), name, cust % 40 + i, F.lit("Unidade")
        else:
            lote = F.when(key % 9 == 0, F.lit(None)).otherwise(text(" G", i))
            objeto = F.when(key % 4 == 0, F.replace(name, F.lit("A"), F.lit(""))).when(
                key % 4 == 1, F.concat(F.lower(name), F.lit(" abcdef"))
            ).otherwise(name)
            quantity = cust % 40 + i + F.when(key % 6 == 0, 1).otherwise(0)
            unit = F.when(key % 5 == 0, F.lit("Caixa")).otherwise(F.lit(" UNIDADE "))
        return F.struct(
            lote.alias("lote"), big(i).alias("item"), objeto.alias("objeto"), big(quantity).alias("quantidade"),
            unit.alias("unidade_fornecimento"),
        )

    items = F.transform(F.sequence(F.lit(1), size.cast("int")), item)
    return t.spread("orders", *ORDER_COLUMNS).select(key.alias("arquivo_json"), items.alias("itens_extraidos"))


def _compared(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    pred, gold = _order_list(t, key % 3 + 1, False), _order_list(t, key % 2 + 2, True)
    return scoring.compare_items(scoring.align_items(scoring.item_rows(pred), scoring.item_rows(gold)))


SCORE_SQL = """
    WITH pairs AS (
      SELECT o_orderkey AS k, i, 'MATERIAL ' || o_orderpriority || ' TIPO ' || o_custkey % 50 || ' ' || o_orderstatus || ' PARTE ' || i AS nome
      FROM (SELECT *, unnest(range(1, least(o_orderkey % 3 + 1, o_orderkey % 2 + 2) + 1)) AS i FROM orders))
    , texts AS (
      SELECT *, lower(nome) AS g, lower(CASE k % 4 WHEN 0 THEN replace(nome, 'A', '') WHEN 1 THEN nome || ' abcdef' ELSE nome END) AS p FROM pairs)
    , checked AS (
      SELECT k AS arquivo_json, i - 1 AS pos, true AS ok_item, k % 6 <> 0 AS ok_quantidade, k % 9 <> 0 AS ok_lote,
             1 - levenshtein(p, g) / greatest(length(p), length(g)) >= 0.85 AS ok_objeto, k % 5 <> 0 AS ok_unidade_fornecimento
      FROM texts)
    , scored AS (SELECT *, ok_item AND ok_quantidade AND ok_lote AND ok_objeto AND ok_unidade_fornecimento AS ok_todos FROM checked)
"""
_OK = ("ok_item", "ok_quantidade", "ok_lote", "ok_objeto", "ok_unidade_fornecimento", "ok_todos")


@query(
    SCORE_SQL
    + "SELECT arquivo_json, CAST(pos AS BIGINT) AS pos, "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _OK)
    + " FROM scored"
)
def score_items(t: Tables) -> DataFrame:
    """JO4, EV1, SF4."""
    return _compared(t).select("arquivo_json", big("pos").alias("pos"), *[big(F.col(c).cast("int")).alias(c) for c in _OK])


@query(
    SCORE_SQL
    + """
    , totals AS (SELECT count(*) AS n, """
    + ", ".join(f"count(*) FILTER ({c}) AS {c}" for c in _OK)
    + """ FROM scored)
    SELECT replace(campo, 'ok_', '') AS campo, CAST(acertos AS BIGINT) AS acertos, CAST(n AS BIGINT) AS comparados,
           round(100.0 * acertos / n, 6) AS pct
    FROM (UNPIVOT totals ON """
    + ", ".join(_OK)
    + " INTO NAME campo VALUE acertos)"
)
def accuracy_summary(t: Tables) -> DataFrame:
    """AG2."""
    return scoring.accuracy_summary(_compared(t)).withColumn("pct", F.round("pct", 6))


@query(
    SCORE_SQL
    + """
    , flags AS (SELECT arquivo_json, """
    + ", ".join(_OK)
    + """ FROM scored)
    , totals AS (SELECT count(*) AS n, """
    + ", ".join(f"count(*) FILTER ({c}) AS {c}" for c in _OK)
    + """ FROM flags)
    , fields AS (SELECT replace(campo, 'ok_', '') AS campo, acertos, n FROM (UNPIVOT totals ON """
    + ", ".join(_OK)
    + """ INTO NAME campo VALUE acertos))
    , notices AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 6 > 0) AS validas, sum(o_orderkey % 3 + 1) FILTER (o_orderkey % 6 > 0) AS itens,
             sum(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END) FILTER (o_orderkey % 6 > 0) AS com_lote FROM orders)
    SELECT campo, CAST(acertos AS BIGINT) AS acertos, CAST(n AS BIGINT) AS total FROM (
      SELECT * FROM fields UNION ALL SELECT 'licitacoes válidas', validas, n FROM notices UNION ALL SELECT 'itens com lote', com_lote, itens FROM notices)
    """
)
def evaluation(t: Tables) -> DataFrame:
    """The scoring plan (AG1, AG2, AG5, JO4, EV1): results in parts of two items against an answer set whose last row per file wins."""
    key = F.col("o_orderkey")
    fields = {"numero_pregao": text("PE/", F.col("arquivo_json")), "orgao": F.lit("o"), "cidade": F.lit("c"),
              "estado": F.when(F.col("arquivo_json") % 6 > 0, "PR").otherwise("pr"), "anexos_processados": F.array().cast("array<string>")}

    def in_parts(lists: DataFrame, n: int) -> DataFrame:
        parts = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("itens_extraidos") - 1) / n).cast("int")),
            lambda k: F.struct(k.cast("bigint").alias("parte"), F.slice("itens_extraidos", k * n + 1, F.lit(n)).alias("itens_extraidos")),
        )
        return lists.select(*[c for c in lists.columns if c != "itens_extraidos"], F.inline(parts))

    pred = in_parts(_order_list(t, key % 3 + 1, False).withColumns(fields), 2)
    last = _order_list(t, key % 2 + 2, True).withColumn("pos", F.lit(7))
    earlier = last.withColumns({"pos": F.lit(3), "itens_extraidos": F.slice("itens_extraidos", 1, 1)})
    result = evaluate(pred, in_parts(last.unionByName(earlier), 2))
    counts = (("licitacoes válidas", "licitacoes_validas", "licitacoes"), ("itens com lote", "itens_com_lote", "itens"))
    lines = [F.struct(F.lit(name).alias("campo"), F.col(hits).alias("acertos"), F.col(total).alias("total")) for name, hits, total in counts]
    summary = result.summary.select(F.inline(F.array(*[line.cast("struct<campo:string,acertos:bigint,total:bigint>") for line in lines])))
    return result.accuracy.select("campo", "acertos", F.col("comparados").alias("total")).unionByName(summary)


@query(
    """
    SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id
    FROM events GROUP BY user_id
    """
)
def dedupe_last(t: Tables) -> DataFrame:
    """AG5: the last event of each user."""
    return scoring.dedupe_last(t.events.select("user_id", "event_type", "value", "event_id"), ["user_id"], "event_id")


# --- call log and failures -------------------------------------------------------------------


@query(
    f"""
    WITH log AS (
      SELECT event_id AS call_id, event_type = 'purchase' AS ok, {CLASS_SQL} AS classe
      FROM (SELECT event_id, event_type, {ERROR_SQL} AS e FROM events))
    , counted AS (
      SELECT *, sum(CASE WHEN classe = 'rate_limit' THEN 1 ELSE 0 END) OVER (ORDER BY call_id) AS cum FROM log)
    , based AS (SELECT *, coalesce(max(CASE WHEN ok THEN cum END) OVER (ORDER BY call_id), 0) AS base FROM counted)
    SELECT call_id, classe, CAST(cum - base AS BIGINT) AS sequencia,
           CAST(coalesce(classe = 'rate_limit' AND cum - base >= 2, false) AS BIGINT) AS disparo FROM based
    """
)
def rate_limit_streaks(t: Tables) -> DataFrame:
    """WI4, SF8 over the events as one call log."""
    log = t.events.select(
        F.col("event_id").alias("call_id"), (F.col("event_type") == "purchase").alias("ok"), call_error().alias("error")
    )
    return streaks(log).select("call_id", "classe", "sequencia", big(F.col("disparo").cast("int")).alias("disparo"))


@query(
    """
    SELECT '- **Data/Hora:** ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) || '- **Arquivo JSON Origem:** ' || user_id || '.json' || chr(10)
           || '- **Anexo Falho:** anexo_' || event_id || '.pdf' || chr(10) || '- **Motivo:** ' || props || chr(10) AS value
    FROM events WHERE event_type = 'error'
    """
)
def failure_report(t: Tables) -> DataFrame:
    """SC7."""
    failures = t.events.where("event_type = 'error'").select(
        "ts",
        text(F.col("user_id"), ".json").alias("arquivo_json"),
        text("anexo_", F.col("event_id"), ".pdf").alias("anexo"),
        F.col("props").alias("motivo"),
    )
    return failure_report_lines(failures)


# --- rendering -------------------------------------------------------------------------------


def parts_sql(doc: str, size: int, out: str, of: str = "") -> str:
    """The texts ``t`` of ``joined (doc, t)`` in parts of ``size`` characters."""
    return f"""
    SELECT {doc}, CAST(k AS BIGINT) AS part_no, {of}(substr(t, k * {size} + 1, {size})) AS {out}
    FROM joined, unnest(range(greatest(1, (length(t) + {size - 1}) // {size}))) AS u(k)
    """



@query(
    """
    WITH rows AS (
      SELECT c_nationkey AS doc, c_custkey AS row_no,
             CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN [c_name, c_mktsegment, 'v ' || c_nationkey] ELSE ['', c_name] END AS cells
      FROM customer)
    , kept AS (SELECT *, min(row_no) OVER (PARTITION BY doc) AS head, max(len(cells)) OVER (PARTITION BY doc) AS width
               FROM rows WHERE cells IS NOT NULL)
    , lines AS (
      SELECT *, '| ' || array_to_string(list_resize(cells, width, ''), ' | ') || ' |'
             || CASE WHEN row_no = head THEN chr(10) || '| ' || array_to_string(list_resize(['---'], width, '---'), ' | ') || ' |' ELSE '' END AS line
      FROM kept)
    , joined AS (SELECT doc, string_agg(line, chr(10) ORDER BY row_no) AS t FROM lines GROUP BY doc)
    """
    + parts_sql("CAST(doc AS BIGINT) AS doc", 2000, "markdown")
)
def markdown_tables(t: Tables) -> DataFrame:
    """MD1, SF6: the customers of a nation as one table; rows are ragged, some all blank."""
    key, name = F.col("c_custkey"), F.col("c_name")
    cells = (
        F.when(key % 5 == 0, F.array(F.lit(None).cast("string"), F.lit(" \n")))
        .when(key % 3 == 0, F.array(name, F.concat(F.lit(" "), "c_mktsegment"), text("v\n", F.col("c_nationkey"))))
        .otherwise(F.array(F.lit(""), name))
    )
    df = t.customer.select(
        F.col("c_nationkey").cast("bigint").alias("doc"), key.alias("row_no"), F.posexplode(cells).alias("col_no", "text")
    )
    return render.table_to_markdown(df, ["doc"], part_chars=2000)


@query(
    """
    WITH pages AS (
      SELECT source AS doc, doc_id AS page_no, trim(text, E' \\t\\n\\r') AS txt, quality FROM documents LEFT JOIN labels USING (doc_id))
    , sections AS (
      SELECT doc, page_no, CASE
        WHEN quality IS NULL THEN CASE WHEN txt <> '' THEN '### Página ' || page_no || chr(10) || txt END
        ELSE '### Página ' || page_no || CASE WHEN quality = 1 THEN chr(10) || chr(10) || '| 1 |' || chr(10) || chr(10) || '| q |' ELSE '' END
             || CASE WHEN txt <> '' THEN chr(10) || chr(10) || '**Contexto da Página ' || page_no || ':**' || chr(10) || txt ELSE '' END END AS section
      FROM pages)
    , joined AS (SELECT doc, string_agg(section, chr(10) || chr(10) ORDER BY page_no) AS t FROM sections WHERE section IS NOT NULL GROUP BY doc)
    """
    + parts_sql("doc", 50000, "hash", "md5")
)
def page_markdown(t: Tables) -> DataFrame:
    """MD2: the documents of a source as pages; labelled ones hold tables."""
    pages = t.documents.select(F.col("source").alias("doc"), F.col("doc_id").alias("page_no"), "text")
    drawn = F.when(F.col("quality") == 1, F.array(F.lit("| q |"), F.lit("| 1 |"))).otherwise(F.array(F.lit("")))
    tables = t.labels.join(t.documents.select("doc_id", "source"), "doc_id").select(
        F.col("source").alias("doc"), F.col("doc_id").alias("page_no"), F.posexplode(drawn).alias("n", "markdown")
    )
    tables = tables.withColumn("table_no", -F.col("n"))
    return render.assemble_pages(pages, tables, part_chars=50_000).select("doc", "part_no", F.md5("markdown").alias("hash"))


@query(
    """
    WITH joined AS (
      SELECT conv_id AS doc, string_agg(trim(text, E' \\t\\n\\r'), chr(10) || chr(10) ORDER BY turn) AS t
      FROM conversations WHERE regexp_matches(text, '\\S') AND role <> 'system' GROUP BY conv_id)
    """
    + parts_sql("doc", 300, "markdown")
)
def block_markdown(t: Tables) -> DataFrame:
    """MD3: turns as blocks; system turns stand for blank paragraphs."""
    body = F.when(F.col("role") == "system", F.lit(" \n")).otherwise(F.col("text"))
    blocks = t.conversations.select(F.col("conv_id").alias("doc"), F.col("turn").alias("block_no"), body.alias("text"))
    return render.assemble_blocks(blocks, part_chars=300)


def _sheets(t: Tables) -> tuple[DataFrame, DataFrame]:
    key, size = F.col("p_partkey"), F.col("p_size")
    cell = F.array(
        F.struct(F.lit("").alias("text"), F.lit(9).alias("repeat")),
        F.struct(F.concat(F.lit(" "), "p_name").alias("text"), F.when(key % 2 == 0, 4).otherwise(1).alias("repeat")),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("repeat")),
        F.struct(F.when(key % 4 == 0, F.lit("")).otherwise(F.col("p_type")).alias("text"), F.lit(2).alias("repeat")),
    )
    cells = t.part.select(
        F.col("p_brand").alias("doc"), size.alias("table_no"), key.alias("row_no"), F.posexplode(cell).alias("col_no", "c")
    ).select("doc", "table_no", "row_no", "col_no", "c.text", "c.repeat")
    name = F.when(size % 2 == 0, text("P", size)).otherwise(F.lit(""))
    sheets = t.part.select(F.col("p_brand").alias("doc"), size.alias("table_no"), name.alias("name")).distinct()
    return cells, sheets


SHEET_SQL = """
    WITH lines AS (
      SELECT p_brand AS doc, p_size AS table_no, p_partkey AS row_no,
             '| ' || p_name || ' | ' || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ' | ' || p_type END || ' |' AS line
      FROM part
      UNION ALL
      SELECT DISTINCT p_brand, p_size, -1, chr(10) || '### Tabela: P' || p_size FROM part WHERE p_size % 2 = 0)
"""


@query(SHEET_SQL + "SELECT doc, CAST(table_no AS BIGINT) AS table_no, CAST(row_no AS BIGINT) AS row_no, line FROM lines")
def sheet_lines(t: Tables) -> DataFrame:
    """MD4: lines."""
    return render.sheet_lines(*_sheets(t)).select("doc", big("table_no").alias("table_no"), big("row_no").alias("row_no"), "line")


@query(
    SHEET_SQL
    + ", joined AS (SELECT doc, string_agg(line, chr(10) ORDER BY table_no, row_no) AS t FROM lines GROUP BY doc)"
    + parts_sql("doc", 500, "text")
)
def sheet_texts(t: Tables) -> DataFrame:
    """MD4: the parts of a brand as one spreadsheet."""
    return render.sheets_to_text(*_sheets(t), part_chars=500)


@query(
    """
    WITH lines AS (
      SELECT conv_id AS doc, 2 * turn AS block_no, -1 AS row_no, trim(text, E' \\t\\n\\r') AS line FROM conversations WHERE regexp_matches(text, '\\S')
      UNION ALL SELECT conv_id, 2 * turn + 1, 0, '| ' || role || ' | ' || turn || ' |' FROM conversations)
    , joined AS (SELECT doc, string_agg(line, chr(10) ORDER BY block_no, row_no) AS t FROM lines GROUP BY doc)
    """
    + parts_sql("doc", 300, "text")
)
def text_doc_lines(t: Tables) -> DataFrame:
    """MD5: turns as paragraphs, each followed by a table of its role and number."""
    doc = F.col("conv_id").alias("doc")
    blocks = t.conversations.select(doc, (F.col("turn") * 2).alias("block_no"), "text")
    row = F.array(F.concat("role", F.lit(" ")), text(F.col("turn")))
    cells = t.conversations.select(
        doc, (F.col("turn") * 2 + 1).alias("block_no"), F.lit(0).alias("row_no"), F.posexplode(row).alias("col_no", "text")
    )
    return render.text_docs_to_text(blocks, cells, part_chars=300)
