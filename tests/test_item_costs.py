"""What the item parsers evaluate per text, and which attachments are put together."""

import pytest
from pyspark.sql import functions as F

from bidlines.functions import patterns as P
from bidlines.functions.text import split_at
from bidlines.operators.answers import parse_rescue_answers
from bidlines.operators.items import parse_notice_items
from bidlines.operators.pages import PAGE_WORDS, long_attachments, parse_attachment_items, parse_paged_attachments

FIELDS = ("k", "lote", "item", "objeto", "quantidade", "unidade_fornecimento")
NOTICE = "-----\n1 - pa\nQuantidade: 3\nUnidade de fornecimento: Par\n"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_header_and_quantity_of_a_block_are_looked_for_once(spark, rows):
    df = spark.createDataFrame([("n", [NOTICE])], "k string, itens array<string>")
    items = parse_notice_items(df, ["k"])
    assert rows(items, *FIELDS) == [("n", None, 1, "pa", 3, "Par")]
    # The label alone also stands in the prefixes of lines that are left out.
    assert plan_of(items).count(P.NOTICE_HEADER) == 1
    assert plan_of(items).count(P.NOTICE_QUANTITY) == 1


def test_quantity_of_an_attachment_block_is_looked_for_once(spark, rows):
    df = spark.createDataFrame([("n", NOTICE[6:])], "k string, text string")
    items = parse_attachment_items(df, ["k"])
    assert rows(items, *FIELDS) == [("n", None, 1, "pa", 3, "Par")]
    assert plan_of(items).count(P.ATTACHMENT_QUANTITY) == 1


@pytest.mark.parametrize("text", ["", "\n1-", "a\n1 - b\n2-c\n", "-----\n1-a", "a\0b\n1-\0", "\0", "------", "----\n--", None])
@pytest.mark.parametrize("pattern", [P.ITEM_START, P.NOTICE_SPLIT])
def test_split_at_is_split(spark, text, pattern):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(split_at(F.col("t"), pattern).alias("a"), F.split("t", rf"-{{5,}}|{P.ITEM_START}" if pattern == P.NOTICE_SPLIT else pattern, -1).alias("b")).first()
    assert row["a"] == row["b"]


def test_an_answer_is_not_typed_as_a_whole(spark):
    """The type of a whole answer takes a pass over it; the type of each field is taken once."""
    df = spark.createDataFrame([("n", "[]")], "k string, raw string")
    assert plan_of(parse_rescue_answers(df, ["k"])).count("schemaOfVariant(") == 5


PAGES = [
    (1, "EDITAL\nComposição dos Grupos\nG1\nItem 1\nG2\nItem 2\n1 - pa azul\nQuantidade Total: 3\n2"),
    (2, " - pedra\nQuantidade: 4\nUnidade de Fornecimento: Caixa"),
    (3, None),
    (4, "Unidade de Fornecimento: Par\n0 - nada\nQuantidade: 1"),
]


def frame(spark, pages, keys=("a",)):
    return spark.createDataFrame([(k, no, t) for k in keys for no, t in pages], "k string, page_no int, text string").repartition(3)


def test_short_and_long_attachments_give_the_same_items(spark, rows):
    df = frame(spark, PAGES, ("a", "b"))
    short, by_page, mixed = (rows(parse_paged_attachments(df, ["k"], **kw), *FIELDS) for kw in ({}, {"whole_chars": 0}, {"whole_chars": 200}))
    assert short == by_page == mixed and len(short) == 4
    more = df.unionByName(frame(spark, [(no, f"{t or ''}{'x ' * 99}") for no, t in PAGES], ("long",)))
    assert rows(parse_paged_attachments(more, ["k"], whole_chars=400), *FIELDS) == rows(parse_paged_attachments(more, ["k"]), *FIELDS)


def test_short_attachments_take_few_exchanges(spark):
    items = parse_paged_attachments(frame(spark, PAGES), ["k"])
    assert items._jdf.queryExecution().sparkPlan().toString().count("Window") == 0
    assert plan_of(items).count("Join ") == 1


@pytest.mark.parametrize("numbers", [[1, 1], [1, None], [0, 64 * PAGE_WORDS], [-1, 1]])
def test_odd_page_numbers_are_not_put_together(spark, rows, numbers):
    df = frame(spark, [(no, "t") for no in numbers])
    assert rows(long_attachments(df, ["k"])) == [("a",)]
    assert rows(long_attachments(frame(spark, [(no, "t") for no in range(64 * PAGE_WORDS)]), ["k"])) == []
