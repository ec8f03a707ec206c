import random

from pyspark.sql import functions as F

from bidlines.operators.groups import group_mapping
from bidlines.operators.items import clean_items, parse_notice_items
from bidlines.operators.pages import join_pages, paged_blocks, parse_attachment_items, parse_paged_attachments

FIELDS = ("k", "lote", "item", "objeto", "quantidade", "unidade_fornecimento")


def notice(spark, rows, *texts):
    df = spark.createDataFrame([("n", list(texts))], "k string, itens array<string>")
    return rows(parse_notice_items(df, ["k"]), *FIELDS[1:])


def test_two_items(spark, rows):
    text = (
        "1 - MANGUEIRA DE JARDIM\nMANGUEIRA 30 M TRANÇADA\nQuantidade: 7\nUnidade de fornecimento: Peça\n"
        "----------\n2 - BALDE PLÁSTICO\nBALDE 12 LITROS VERDE\nQuantidade: 35\nUnidade de fornecimento: Fardo 6 UN"
    )
    assert notice(spark, rows, text) == [
        (None, 1, "MANGUEIRA DE JARDIM MANGUEIRA 30 M TRANÇADA", 7, "Peça"),
        (None, 2, "BALDE PLÁSTICO BALDE 12 LITROS VERDE", 35, "Fardo 6 UN"),
    ]


def test_real_shape(spark, rows):
    text = (
        "----------------------------------------\r\nItens de Material\r\n----------------------------------------\r\n"
        "1 - JOGO / BRINQUEDO\r\nJOGO / BRINQUEDO, TIPO PVC,QUANTIDADE 51 PEÇAS, COR AZUL\r\nTratamento Diferenciado: -\r\n"
        "Aplicabilidade Decreto 7174: Não\r\nQuantidade: 6\r\nUnidade de fornecimento: Unidade\r\n----------\r\n"
        "2 - FITA\r\nFITA LARGA, 3 PARTES, QUANTIDADE 9\r\nQuantidade: 1.000\r\nUnidade de fornecimento: Rolo 1.\r\n"
    )
    assert notice(spark, rows, text) == [
        (None, 1, "JOGO / BRINQUEDO, TIPO PVC,QUANTIDADE 51 PEÇAS, COR AZUL", 6, "Unidade"),
        (None, 2, "FITA LARGA, 3 PARTES", 1, "Rolo 1"),
    ]


def test_texts_without_items(spark, rows):
    assert notice(spark, rows, "") == []
    assert notice(spark, rows) == []
    assert notice(spark, rows, "Aquisição de papel para a sede.") == []
    assert notice(spark, rows, "1 - Cadeado\r\n2 - Corrente") == []
    assert notice(spark, rows, "Lote: 1 - \r\nDescrição: Mesa\r\nQuantidade: 4") == []
    assert notice(spark, rows, "0 - Nada\nQuantidade: 4") == []
    assert notice(spark, rows, "4 - Nada\nQuantidade: 0") == []
    assert notice(spark, rows, f"{'9' * 30} - Nada\nQuantidade: 4") == []


def test_strings_of_one_notice_are_joined_by_a_newline(spark, rows):
    got = notice(spark, rows, "1 - Mesa\nQuantidade: 4", "2 - Pá\nQuantidade: 5")
    assert got == [(None, 1, "Mesa", 4, "Unidade"), (None, 2, "Pá", 5, "Unidade")]


def test_first_quantity_anywhere_in_the_block_wins(spark, rows):
    assert notice(spark, rows, "1 - Kit\nKit com QUANTIDADE: 51 peças\nQuantidade: 6") == [
        (None, 1, "Kit com", 51, "Unidade")
    ]


def test_wrapped_number_line_starts_a_block_and_takes_the_quantity(spark, rows):
    assert notice(spark, rows, "1 - Tubo\nTubo de\n35 - mm\nQuantidade: 6") == [(None, 35, "mm", 6, "Unidade")]


def test_lone_carriage_return_hides_an_item_number(spark, rows):
    assert notice(spark, rows, "Itens\r1 - Pá\nQuantidade: 2") == []


def test_blank_unit_takes_the_next_line(spark, rows):
    assert notice(spark, rows, "1 - Pá\nUnidade de fornecimento:  \nQuantidade: 5") == [
        (None, 1, "Pá", 5, "Quantidade: 5")
    ]


ATTACHMENT = """Composição dos Grupos
G1
Item 1
Item 2
1 - Mesa
Descrição Detalhada: Mesa de madeira
Quantidade Total: 4
Unidade de Fornecimento: Unidade
2 - Cadeira
Grupo: 2
Quantidade Total: 8
Unidade de Fornecimento: Unidade"""


def attachment(spark, rows, text):
    df = spark.createDataFrame([("a", text)], "k string, text string")
    return rows(parse_attachment_items(df, ["k"]), *FIELDS[1:])


def paged(spark, rows, pages, **kw):
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate(pages, 1)], "k string, page_no int, text string")
    return rows(parse_paged_attachments(df, ["k"], **kw), *FIELDS[1:])


def test_attachment_groups(spark, rows):
    expected = [("G1", 1, "Mesa Mesa de madeira", 4, "Unidade"), ("G2", 2, "Cadeira Grupo: 2", 8, "Unidade")]
    # "Mesa Mesa de madeira" is a repeated title, so one "Mesa" goes.
    expected[0] = ("G1", 1, "Mesa de madeira", 4, "Unidade")
    assert attachment(spark, rows, ATTACHMENT) == expected
    assert paged(spark, rows, [ATTACHMENT]) == expected


def test_attachment_lines(spark, rows):
    text = (
        "  1 - Pá\nDescrição Detalhada: Pá larga Descrição Detalhada: de aço\n123\nDescrição Detalhada: 456\n"
        "Descrição Detalhada: Valor fixo\nlinha livre Descrição Detalhada: fica\nCritério de Julgamento: menor\n"
        "Intervalo Mínimo: 1\nLocal de Entrega: aqui\nPREGÃO 90\nLote: g7\nQuantidade: 3\n"
        "Unidade de fornecimento: Caixa Valor 3\n"
    )
    assert attachment(spark, rows, text) == [
        ("G7", 1, "Pá larga de aço 456", 3, "Caixa")
    ]


def test_inline_header_only_at_block_start(spark, rows):
    assert attachment(spark, rows, "Título\r1 - Pá\nQuantidade: 3") == []
    assert attachment(spark, rows, "Título\n1 - Pá\nQuantidade: 3") == [(None, 1, "Pá", 3, "Unidade")]


def test_group_mapping_last_group_wins(spark, rows):
    text = "x\ncomposição dos grupos  \n\nG1 \nItem 1\nItem2\nG2\nITEM 1\nItem 3\ng9\nItem 4\n 1 - fim\nG3\nItem 9"
    df = spark.createDataFrame([("a", text), ("b", "G1\nItem 1"), ("c", None)], "k string, text string")
    assert rows(group_mapping(df, ["k"])) == [
        ("a", 1, "G2"), ("a", 2, "G1"), ("a", 3, "G2"), ("a", 4, "G2"),
    ]


def test_pages_give_the_items_of_the_whole_text(spark, rows):
    long = [
        "Edital\nComposição dos Grupos",
        "G1\nItem 1\nItem 3",
        None,
        "G2\nItem 2",
        "1 - Mesa\nDescrição Detalhada: Mesa",
        "de madeira\nQuantidade Total: 4",
        "",
        "Unidade de Fornecimento: Par\n2 - Cadeira\nQuantidade: 5\n3 - Armário\n7",
        "Quantidade: 6\n4",
        "  ",
        "- Estante\nQuantidade: 7\n12",
        "fim da página 12",
        "5 - Banco\nQuantidade: 8",
    ]
    whole = attachment(spark, rows, "\n".join(t or "" for t in long))
    assert [r[1] for r in whole if r[1]] and len(whole) == 5
    assert paged(spark, rows, long) == whole


def test_blank_pages_before_the_first_item(spark, rows):
    for long in (["", " 1 - Pá\nQuantidade: 3"], [" \n", None, "\t1", "- Pá\nQuantidade: 3"], ["  12 - Pá", "Quantidade: 3"]):
        whole = attachment(spark, rows, "\n".join(t or "" for t in long))
        assert len(whole) == 1 and paged(spark, rows, long) == whole
    for long in (["x", " 1 - Pá\nQuantidade: 3"], ["Quantidade: 3", "12"], ["12 Quantidade: 3", "- x"]):
        assert paged(spark, rows, long) == attachment(spark, rows, "\n".join(long)) == []


def test_random_cuts_of_a_text_give_its_items(spark, rows):
    rng = random.Random(11)
    lines = [
        "1 - Mesa", "2", "- Cadeira", "Quantidade: 4", "Quantidade", "Total: 5", "texto livre", "", " ", "Grupo: 3", "Unidade de Fornecimento: Par", "7 - Banco alto",
        "Composição dos Grupos", "G1", "Item 1", "Item", "7", "G2 ", "item 2 e Item 1", "fim G9", "8-", "  9 - Armário", "12\t",
    ]
    texts = {f"k{n}": [rng.choice(lines) for _ in range(rng.randrange(1, 40))] for n in range(200)}
    pages = []
    for k, whole in texts.items():
        page = []
        at = 0
        while at < len(whole):
            step = rng.randrange(1, 7)
            page.append("\n".join(whole[at : at + step]))
            at += step
        pages += [(k, n, t or None) for n, t in enumerate(page, 1)]
    keys = ["k"]
    one = spark.createDataFrame([(k, "\n".join(t)) for k, t in texts.items()], "k string, text string")
    cut = spark.createDataFrame(pages, "k string, page_no int, text string").repartition(5)
    fields = ("k", "lote", "item", "objeto", "quantidade", "unidade_fornecimento")
    whole = rows(parse_attachment_items(one, keys), *fields)
    assert len(whole) > 40 and any(r[1] for r in whole)
    assert rows(parse_paged_attachments(cut, keys), *fields) == whole


def test_a_block_over_many_pages_and_tasks(spark, rows):
    pages = [("a", i, f"texto {i}" if i % 7 else f"{i} - Item {i}\nQuantidade: {i}") for i in range(1, 60)]
    pages += [("b", i, "\n9" if i == 4 else "- resto" if i == 9 else "Quantidade: 2" if i == 30 else "") for i in range(1, 32)]
    pages += [("c", i, "1 - sem número" if i == 1 else "linha") for i in range(1, 40)]
    df = spark.createDataFrame(pages, "k string, page_no int, text string")
    found = {}
    for tasks in (1, 3, 16):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found[tasks] = rows(paged_blocks(df, ["k"]))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found[1] == found[3] == found[16]
    by_key = {k: [r for r in found[1] if r[0] == k] for k in "abc"}
    assert len(by_key["a"]) == 8 and len(by_key["b"]) == 1
    assert by_key["c"] == []  # no quantity: its text is not gathered


def test_join_pages_in_order_and_in_parts(spark, rows):
    df = spark.createDataFrame([("a", i, str(i) if i != 3 else None) for i in (4, 2, 3, 1, 10)] + [("b", 1, None), (None, 2, "é" * 9)], "k string, page_no int, text string")
    assert rows(join_pages(df, ["k"])) == [("a", 0, "1\n2\n\n4\n10"), ("b", 0, ""), (None, 0, "é" * 9)]
    for size in (1, 2, 3, 4, 100):
        parts = join_pages(df, ["k"], part_chars=size).orderBy("k", "part_no").collect()
        for key, whole in (("a", "1\n2\n\n4\n10"), ("b", ""), (None, "é" * 9)):
            mine = [p for p in parts if p["k"] == key]
            assert "".join(p["text"] for p in mine) == whole
            assert [p["part_no"] for p in mine] == list(range(max(1, -(-len(whole) // size))))
            assert all(len(p["text"]) == size for p in mine[:-1]) and len(mine[-1]["text"]) <= size


def test_long_pages_give_no_long_value(spark):
    df = spark.createDataFrame([(1, n, f"{n:03d}" * 7000) for n in range(40)], "k int, page_no int, text string")
    parts = join_pages(df, ["k"], part_chars=10_000).orderBy("part_no").collect()
    assert max(len(p["text"]) for p in parts) == 10_000
    assert "".join(p["text"] for p in parts) == "\n".join(f"{n:03d}" * 7000 for n in range(40))


def test_items_are_cleaned_again(spark, rows):
    df = spark.createDataFrame([("A A", "Caixa..,")], "objeto string, unidade_fornecimento string")
    assert rows(clean_items(df)) == [("A", "Caixa..")]
