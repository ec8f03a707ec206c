"""Item parsing over texts that are composed from the tables, row by row.

Texts are built without grouping (a notice per line item or per order), so composing them
scales with the tables and the checks are plain selects of the rows they were built from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    base_name,
    clean_description,
    clean_unit,
    error_class,
    file_stem,
    has_relevant_extension,
    is_blocked_name,
    is_relevant_attachment,
    text_similarity,
)
from ..operators.answers import parse_rescue_answers
from ..operators.groups import group_mapping
from ..operators.items import parse_notice_items
from ..operators.pages import join_pages, parse_attachment_items, parse_paged_attachments
from ..sources.shared import cut_lineage
from .registry import Tables, big, query, text

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_notices(t: Tables) -> DataFrame:
    """One notice per line item: two item blocks and one without a quantity."""
    part = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    line = t.spread("lineitem", *LINE_KEYS, "l_quantity")
    number = F.col("l_linenumber")
    notice = text(
        "----------------------------------------\r\nItens de Material\r\n",
        "----------------------------------------\r\n",
        number, " - ", F.col("p_name"), "\r\n",
        F.col("p_name"), ", TIPO ", F.col("p_type"), "\r\n",
        "Tratamento Diferenciado: -\r\nAplicabilidade Decreto 7174: Nao\r\n",
        "Quantidade: ", big("l_quantity"), "\r\nUnidade de fornecimento: ", F.col("p_type"), "\r\n----------\r\n",
        number + 7, " - ", F.col("p_brand"), "\r\nMEDIDA ", F.col("p_size"), " CM, VALOR 9\r\n",
        "QUANTIDADE: ", big("l_suppkey") + 1, "\r\nUnidade de fornecimento: Caixa ", F.col("p_size"),
        " UN Quantidade maxima 3\r\n----------\r\n99 - ", F.col("p_name"), "\r\nsem contagem\r\n",
    )
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(*LINE_KEYS, F.array(notice).alias("itens"))


@query(
    """
    WITH base AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_name, p_type, p_brand, p_size
      FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS item, p_name || ', TIPO ' || p_type AS objeto,
           CAST(l_quantity AS BIGINT) AS quantidade, p_type AS unidade_fornecimento
    FROM base
    UNION ALL
    SELECT l_orderkey, CAST(l_linenumber + 7 AS BIGINT), p_brand || ' MEDIDA ' || p_size || ' CM',
           l_suppkey + 1, 'Caixa ' || p_size || ' UN'
    FROM base
    """
)
def notice_items(t: Tables) -> DataFrame:
    """IT1, FI4-FI6, SF1-SF3, VA1."""
    items = parse_notice_items(line_notices(t), LINE_KEYS)
    return items.select("l_orderkey", "item", "objeto", "quantidade", "unidade_fornecimento")


def _per_item(make) -> Column:
    """An order lists 2 to 5 items; ``make`` is applied to each item number."""
    return F.transform(F.sequence(F.lit(1), big(F.col("o_orderkey") % 4 + 2).cast("int")), make)


def _unit(i: Column) -> Column:
    return F.when(i % 2 == 1, text("Caixa ", i, " UN")).otherwise(F.lit("Metro"))


def _composition() -> Column:
    def group(name: str, rest: int) -> Column:
        lines = F.filter(_per_item(lambda i: F.when(i % 2 == rest, text("Item ", i))), lambda x: x.isNotNull())
        return text(name, "\n", F.array_join(lines, "\n"))

    return text("EDITAL ", F.col("o_orderkey"), "\nComposição dos Grupos\n", group("G1", 1), "\n", group("G2", 0))


def _item_head(i: Column) -> Column:
    return text(
        i, " - MATERIAL ", F.col("o_orderstatus"), " ", i, "\nDescrição Detalhada: cor ", F.col("o_orderpriority"),
        "\nQuantidade Total: ", (F.col("o_custkey") * i) % 97 + 1, F.when(i % 3 == 0, text("\nGrupo: ", i)).otherwise(F.lit("")),
    )


def order_pages(t: Tables) -> DataFrame:
    """One attachment per order; the unit line of an item stands on the page after it."""
    n = big(F.col("o_orderkey") % 4 + 2)
    body = _per_item(
        lambda i: text(
            F.when(i > 1, text("Unidade de Fornecimento: ", _unit(i - 1), "\n")).otherwise(F.lit("")), _item_head(i)
        )
    )
    last = text("Unidade de Fornecimento: ", _unit(n), "\nValor total\n")
    pages = F.concat(F.array(_composition()), body, F.array(last))
    return t.spread("orders", *ORDER_COLUMNS).select("o_orderkey", F.posexplode(pages).alias("page", "text")).select(
        "o_orderkey", (F.col("page") + 1).alias("page_no"), "text"
    )


ORDER_ITEMS = """
    WITH n AS (SELECT *, unnest(range(1, o_orderkey % 4 + 3)) AS i FROM orders)
    SELECT o_orderkey,
           CASE WHEN i % 3 = 0 THEN 'G' || i WHEN i % 2 = 1 THEN 'G1' ELSE 'G2' END AS lote,
           CAST(i AS BIGINT) AS item,
           'MATERIAL ' || o_orderstatus || ' ' || i || ' cor ' || o_orderpriority
             || CASE WHEN i % 3 = 0 THEN ' Grupo: ' || i ELSE '' END AS objeto,
           CAST((o_custkey * i) % 97 + 1 AS BIGINT) AS quantidade,
           CASE WHEN i % 2 = 1 THEN 'Caixa ' || i || ' UN' ELSE 'Metro' END AS unidade_fornecimento
    FROM n
"""
_ITEM = ("lote", "item", "objeto", "quantidade", "unidade_fornecimento")


@query(ORDER_ITEMS)
def attachment_items(t: Tables) -> DataFrame:
    """IT2-IT5, FI7, JO2, AG6 on attachments held page by page."""
    return parse_paged_attachments(cut_lineage(order_pages(t)), ["o_orderkey"]).select("o_orderkey", *_ITEM)


@query(ORDER_ITEMS)
def attachment_items_of_text(t: Tables) -> DataFrame:
    """The same on attachments held as one text per row."""
    units = _per_item(lambda i: text(_item_head(i), "\nUnidade de Fornecimento: ", _unit(i)))
    whole = text(_composition(), "\n", F.array_join(units, "\n"))
    return parse_attachment_items(
        t.spread("orders", *ORDER_COLUMNS).select("o_orderkey", whole.alias("text")), ["o_orderkey"]).select(
        "o_orderkey", *_ITEM
    )


@query(
    """
    SELECT o_orderkey, CAST(i AS BIGINT) AS item, CASE WHEN i % 2 = 1 THEN 'G1' ELSE 'G2' END AS lote
    FROM (SELECT o_orderkey, unnest(range(1, o_orderkey % 4 + 3)) AS i FROM orders)
    """
)
def group_composition(t: Tables) -> DataFrame:
    """IT4, AG6."""
    return group_mapping(t.spread("orders", *ORDER_COLUMNS).select("o_orderkey", _composition().alias("text")), ["o_orderkey"])


@query(
    """
    WITH joined AS (SELECT source, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) AS t FROM documents GROUP BY source)
    , parts AS (SELECT source, k, substr(t, k * 50000 + 1, 50000) AS part FROM joined, unnest(range(greatest(1, (length(t) + 49999) // 50000))) AS u(k))
    SELECT source, CAST(k AS BIGINT) AS part_no, md5(part) AS hash, CAST(length(part) AS BIGINT) AS chars FROM parts
    """
)
def joined_pages(t: Tables) -> DataFrame:
    """IT3: the documents of a source as the pages of one text, in parts of 50,000 characters."""
    pages = t.documents.select("source", F.col("doc_id").alias("page_no"), "text")
    return join_pages(pages, ["source"], part_chars=50_000).select(
        "source", "part_no", F.md5("text").alias("hash"), big(F.length("text")).alias("chars")
    )


@query(
    """
    SELECT p_partkey,
           CASE p_partkey % 8 WHEN 2 THEN p_type || ' ' || p_size || '..' WHEN 5 THEN 'Unidade' WHEN 6 THEN p_type || ' Valorado' ELSE p_type || ' ' || p_size END
             AS unidade
    FROM part
    """
)
def clean_units(t: Tables) -> DataFrame:
    """SF1."""
    unit = text(F.col("p_type"), " ", F.col("p_size"))
    kind = F.col("p_partkey") % 8
    raw = (
        F.when(kind == 0, text(unit, " Quantidade Maxima: 3"))
        .when(kind == 1, text("  ", unit, "\tVALOR 10,00."))
        .when(kind == 2, text(unit, "..,"))
        .when(kind == 3, text(unit, " "))
        .when(kind == 4, text(unit, "\nItem 4 Local X"))
        .when(kind == 5, F.lit(" Local X"))
        .when(kind == 6, text(F.col("p_type"), " Valorado"))
        .otherwise(unit)
    )
    return t.part.select("p_partkey", clean_unit(raw).alias("unidade"))


DESCRIPTION_SQL = """
    , words AS (SELECT *, string_split(txt, ' ') AS w FROM flat)
    , bare AS (SELECT *, list_transform(w[1:20], lambda x: translate(lower(x), '.,/;-', '')) AS b FROM words)
    , found AS (
        SELECT *, list_max(list_filter(range(1, 11), lambda k: 2 * k <= len(b) AND b[1:k] = b[k + 1:2 * k]
                                       AND (k > 1 OR b[1] <> ''))) AS k FROM bare)
    , titled AS (SELECT *, CASE WHEN k IS NULL THEN txt ELSE array_to_string(w[k + 1:], ' ') END AS d FROM found)
    , cut AS (
        SELECT *, regexp_replace(d, '(?is) (quantidade|valor|crit[ée]rio|tratamento|aplicabilidade|situa[çc][ãa]o|local|preg[ãa]o)\\b.*', '') AS c
        FROM titled)
"""


@query(
    """
    WITH flat AS (
      SELECT p_partkey, trim(regexp_replace(
        p_name || ' ' || upper(p_name) || ', TIPO ' || p_type || CASE p_partkey % 6
          WHEN 0 THEN ' VALOR 10' WHEN 1 THEN '  quantidade' || chr(10) || '7, resto' WHEN 2 THEN ' LOCALIZADO'
          WHEN 3 THEN ',;' WHEN 4 THEN ' - local, sala ' || p_size ELSE ';' END, '\\s+', ' ', 'g')) AS txt
      FROM part)
    """
    + DESCRIPTION_SQL
    + "SELECT p_partkey, rtrim(rtrim(c, ','), ';') AS objeto FROM cut"
)
def clean_descriptions(t: Tables) -> DataFrame:
    """SF2, SF3 on short descriptions with every kind of tail."""
    kind = F.col("p_partkey") % 6
    tail = (
        F.when(kind == 0, F.lit(" VALOR 10"))
        .when(kind == 1, F.lit("  quantidade\n7, resto"))
        .when(kind == 2, F.lit(" LOCALIZADO"))
        .when(kind == 3, F.lit(",;"))
        .when(kind == 4, text(" - local, sala ", F.col("p_size")))
        .otherwise(F.lit(";"))
    )
    raw = text(F.col("p_name"), " ", F.upper("p_name"), ", TIPO ", F.col("p_type"), tail)
    return t.part.select("p_partkey", clean_description(raw).alias("objeto"))


@query(
    "WITH flat AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS txt FROM documents)"
    + DESCRIPTION_SQL
    + "SELECT doc_id, md5(rtrim(rtrim(c, ','), ';')) AS hash, CAST(length(rtrim(rtrim(c, ','), ';')) AS BIGINT) AS chars FROM cut"
)
def clean_documents(t: Tables) -> DataFrame:
    """SF2, SF3 on whole documents."""
    clean = t.spread("documents", "doc_id", "text").select("doc_id", clean_description(F.col("text")).alias("c"))
    return clean.select("doc_id", F.md5("c").alias("hash"), big(F.length("c")).alias("chars"))


@query(
    """
    SELECT p_partkey, round(similaridade, 9) AS similaridade FROM (
      SELECT p_partkey, 1 - levenshtein(a, b) / greatest(length(a), length(b)) AS similaridade FROM (
        SELECT p_partkey, lower(p_name || ' ' || p_type) AS a, lower(replace(p_name, 'l', '') || ' ' || p_brand) AS b
        FROM part))
    """
)
def similarities(t: Tables) -> DataFrame:
    """SF4."""
    a = text(" ", F.col("p_name"), " ", F.col("p_type"))
    b = text(F.replace("p_name", F.lit("l"), F.lit("")), " ", F.upper("p_brand"), "\n")
    return t.part.select("p_partkey", F.round(text_similarity(a, b), 9).alias("similaridade"))


@query(
    """
    SELECT page_id, nome, CASE WHEN contains(ltrim(nome, '.'), '.') THEN regexp_replace(nome, '\\.[^.]*$', '') ELSE nome END AS radical
    FROM (SELECT page_id, list_last(string_split(rtrim(url, '/'), '/')) AS nome FROM pages)
    """
)
def file_names(t: Tables) -> DataFrame:
    """SF5 on the addresses of pages."""
    return t.pages.select("page_id", base_name(F.col("url")).alias("nome"), file_stem(F.col("url")).alias("radical"))


_NAME_SQL = """
    SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'Edital_' WHEN 1 THEN 'contrato_' WHEN 2 THEN 'TERMO_contrato_'
             WHEN 3 THEN 'Declaracao_' WHEN 4 THEN 'relacaoitens' WHEN 5 THEN 'planilha_custos_' ELSE 'anexo_' END
           || o_custkey || CASE o_orderkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.docx' WHEN 3 THEN '.xls'
             ELSE '.ods' END AS nome FROM orders
"""


def _attachment_name() -> Column:
    head, tail = F.col("o_orderkey") % 7, F.col("o_orderkey") % 5
    first = F.lit("anexo_")
    for k, word in enumerate(("Edital_", "contrato_", "TERMO_contrato_", "Declaracao_", "relacaoitens", "planilha_custos_")):
        first = F.when(head == k, word).otherwise(first)
    last = F.lit(".ods")
    for k, suffix in enumerate((".pdf", ".PDF", ".docx", ".xls")):
        last = F.when(tail == k, suffix).otherwise(last)
    return text(first, F.col("o_custkey"), last)


@query(
    f"""
    SELECT o_orderkey, nome FROM ({_NAME_SQL})
    WHERE regexp_matches(lower(nome), '[.](pdf|docx|odt|ods)$')
      AND (NOT regexp_matches(lower(nome), 'contrato|planilha_custos|ata_registro|declaracao|proposta_de_preco')
           OR regexp_matches(lower(nome), 'edital|termo|relacao'))
    """
)
def relevant_attachments(t: Tables) -> DataFrame:
    """FI1, FI2 together."""
    named = t.orders.select("o_orderkey", _attachment_name().alias("nome"))
    return named.where(is_relevant_attachment(F.col("nome")))


@query(
    f"""
    SELECT CAST(count(*) FILTER (lower(nome) LIKE '%.pdf' OR lower(nome) LIKE '%.docx' OR lower(nome) LIKE '%.ods') AS BIGINT) AS extensao_ok,
           CAST(count(*) FILTER ((lower(nome) LIKE '%contrato%' OR lower(nome) LIKE '%planilha_custos%' OR lower(nome) LIKE '%declaracao%')
                                 AND lower(nome) NOT LIKE '%termo%') AS BIGINT) AS bloqueados
    FROM ({_NAME_SQL})
    """
)
def attachment_name_rules(t: Tables) -> DataFrame:
    """FI1 and FI2 each on its own."""
    named = t.orders.select(_attachment_name().alias("nome"))
    return named.agg(
        F.count_if(has_relevant_extension(F.col("nome"))).alias("extensao_ok"),
        F.count_if(is_blocked_name(F.col("nome"))).alias("bloqueados"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, item, lote, 'peca ' || l_partkey AS objeto,
           CAST(l_quantity AS BIGINT) + item - 1 AS quantidade, 'UN' AS unidade_fornecimento
    FROM (SELECT *, unnest([1, 2])::BIGINT AS item,
                 CASE WHEN l_returnflag = 'A' THEN 'G' || l_linenumber END AS lote FROM lineitem)
    WHERE l_quantity <> 13
    """
)
def rescue_answers(t: Tables) -> DataFrame:
    """IT6, VA1: answers with fences, as list or object; one with a zero item is void as a whole."""
    lote = F.when(F.col("l_returnflag") == "A", text('"G', F.col("l_linenumber"), '"')).otherwise(F.lit("null"))
    quantity = big("l_quantity")

    def item(number: str, amount: Column) -> Column:
        return text(
            '{"lote": ', lote, ', "item": ', number, ', "objeto": "peca ', F.col("l_partkey"), '", "quantidade": ', amount,
            ', "unidade_fornecimento": "UN"}',
        )

    second = F.when(quantity == 13, F.lit(0)).otherwise(quantity + 1)
    listed = text("[", item("1", quantity), ", ", item('"2"', text(second, ".0")), "]")
    raw = (
        F.when(F.col("l_returnflag") == "A", text("```json\n", listed, "\n```"))
        .when(F.col("l_returnflag") == "N", text('{"itens": ', listed, "}"))
        .otherwise(listed)
    )
    answers = t.spread("lineitem", *LINE_KEYS, "l_quantity", "l_returnflag").select(
        "l_orderkey", "l_linenumber", "l_partkey", raw.alias("raw"))
    return parse_rescue_answers(answers, ["l_orderkey", "l_linenumber", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", *_ITEM
    )


ERROR_SQL = """CASE event_type WHEN 'error' THEN '429 Too Many Requests' WHEN 'view' THEN 'Rate Limit ' || user_id
    WHEN 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'Error code: 401' ELSE 'model not found' END
    WHEN 'signup' THEN 'timeout ' || user_id END"""


def call_error() -> Column:
    kind, user = F.col("event_type"), F.col("user_id")
    return (
        F.when(kind == "error", F.lit("429 Too Many Requests"))
        .when(kind == "view", text("Rate Limit ", user))
        .when(kind == "click", F.when(user % 2 == 0, F.lit("Error code: 401")).otherwise(F.lit("model not found")))
        .when(kind == "signup", text("timeout ", user))
    )


CLASS_SQL = f"""CASE WHEN e IS NULL THEN NULL
    WHEN regexp_matches(e, '401|403|invalid_api_key|Unauthorized|Forbidden') THEN 'auth'
    WHEN contains(e, '429') OR regexp_matches(lower(e), 'rate limit|too many requests') THEN 'rate_limit'
    WHEN contains(e, '404') OR contains(lower(e), 'not found') THEN 'not_found' ELSE 'other' END"""


@query(f"SELECT event_id, {CLASS_SQL} AS classe FROM (SELECT event_id, {ERROR_SQL} AS e FROM events)")
def error_classes(t: Tables) -> DataFrame:
    """SF8."""
    return t.events.select("event_id", error_class(call_error()).alias("classe"))
