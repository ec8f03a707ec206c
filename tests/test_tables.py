"""Operators on tables: attachments, cascade, answers, rendering, scoring, nesting, calls."""

import json
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bidlines.operators.answers import parse_rescue_answers
from bidlines.operators.attachments import (
    attachment_failures,
    processed_attachments,
    relevant_attachments,
    resolve_attachments,
)
from bidlines.operators.calls import rate_limit_streaks
from bidlines.operators.cascade import cascade, first_nonempty, pending, tier_coverage
from bidlines.operators.nesting import nest_items, nest_notices
from bidlines.operators.ordered import dense_positions, numbered, running_totals, task_of
from bidlines.operators.quality import rejects, validation_summary
from bidlines.operators.render import (
    assemble_blocks,
    assemble_pages,
    sheets_to_text,
    table_to_markdown,
    text_docs_to_text,
)
from bidlines.operators.rescue import cut_text, rescue_pieces, rescue_queue, rescued_items, unanswered
from bidlines.operators.scoring import accuracy_summary, align_items, compare_items, dedupe_last, item_rows
from bidlines.plans.evaluate import evaluate, evaluate_items
from bidlines.schemas import PROCESSED_NOTICE

FILES = "folder string, file_name string, path string, length bigint"
REFS = "arquivo_json string, att_pos int, folder string, nome string, caminho string"


def files_of(spark, *names):
    return spark.createDataFrame([(f, n, f"/{f}/{n}", size) for f, n, size in names], FILES)


def test_resolution_ranks(spark, rows):
    files = files_of(
        spark, ("a", "x-edital-1.pdf", 9), ("a", "edital.pdf", 8), ("a", "Termo.PDF", 7), ("a", "z_anexo_1.pdf", 0),
        ("a", "b_anexo_10.docx", 5), ("b", "outro.pdf", 4),
    )
    refs = spark.createDataFrame(
        [
            ("a.json", 0, "a", "edital.pdf", "s3://x/x-edital-1.pdf"),
            ("a.json", 1, "a", "edital.pdf", "s3://x/sem.pdf"),
            ("a.json", 2, "a", "edital.pdf", None),
            ("a.json", 3, "a", "termo.pdf", ""),
            ("a.json", 4, "a", "ANEXO_1.pdf", None),
            ("a.json", 5, "a", "z_anexo_1.pdf", None),
            ("a.json", 6, "a", "nada.pdf", None),
            ("b.json", 0, "b", "edital.pdf", None),
            ("c.json", 0, "c", "edital.pdf", None),
        ],
        REFS,
    )
    resolved = resolve_attachments(refs, files)
    assert rows(resolved, "arquivo_json", "att_pos", "rank", "file_name") == sorted(
        [
            ("a.json", 0, 1, "x-edital-1.pdf"),
            ("a.json", 1, 2, "edital.pdf"),
            ("a.json", 2, 2, "edital.pdf"),
            ("a.json", 3, 3, "Termo.PDF"),
            ("a.json", 4, 3, "b_anexo_10.docx"),
            ("a.json", 5, 2, "z_anexo_1.pdf"),
            ("a.json", 6, None, None),
            ("b.json", 0, None, None),
            ("c.json", 0, None, None),
        ],
        key=repr,
    )
    assert rows(attachment_failures(resolved, "downloads/")) == [
        ("a.json", 5, "z_anexo_1.pdf", "Arquivo corrompido ou vazio (0 bytes): z_anexo_1.pdf"),
        ("a.json", 6, "nada.pdf", "Arquivo anexo 'nada.pdf' não foi encontrado em downloads/a"),
        ("b.json", 0, "edital.pdf", "Arquivo anexo 'edital.pdf' não foi encontrado em downloads/b"),
        ("c.json", 0, "edital.pdf", "Pasta de anexos não encontrada: downloads/c"),
    ]
    assert rows(processed_attachments(resolved)) == [
        ("a.json", ["edital.pdf", "edital.pdf", "edital.pdf", "termo.pdf", "ANEXO_1.pdf"])
    ]


def test_resolution_by_stem_equals_brute_force(spark, rows):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abAB_") for _ in range(n))
    names = sorted({(f"f{rng.randint(0, 1)}", word(rng.randint(3, 9)) + ".pdf") for _ in range(60)})
    refs = [("n.json", i, f"f{rng.randint(0, 2)}", word(rng.randint(1, 4)) + ".pdf", None) for i in range(80)]
    got = rows(
        resolve_attachments(spark.createDataFrame(refs, REFS), files_of(spark, *[(f, n, 1) for f, n in names])),
        "att_pos",
        "file_name",
    )

    def brute(folder, nome):
        mine = [n for f, n in names if f == folder]
        if nome in mine:
            return nome
        return min((n for n in mine if nome[:-4].lower() in n.lower()), default=None)

    assert got == sorted(((i, brute(f, n)) for _, i, f, n, _ in refs), key=repr)


def test_stems_equal_a_search_of_all_names(spark, rows):
    rng = random.Random(8)
    letters = "abÁ é_1🙂"
    names = [("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) + rng.choice([".pdf", ".PDF", ".odt", ""])) for _ in range(150)]
    files = [(f"f{rng.randrange(3)}", n) for n in names] + [("f0", "abababab.pdf"), ("f0", None)]
    index = spark.createDataFrame(
        [(f, n, f"/{f}/{k}", k % 3) for k, (f, n) in enumerate(dict.fromkeys(files))], FILES)
    refs = []
    for k in range(200):
        base = rng.choice(names)
        at = rng.randrange(len(base))
        wanted = base[at : at + rng.randrange(1, 8)] if k % 2 else "".join(rng.choice(letters) for _ in range(rng.randrange(1, 5)))
        refs.append(("n", k, f"f{rng.randrange(4)}", wanted + rng.choice([".pdf", ""]), None))
    refs.append(("n", 999, "f0", "ababab.pdf", None))
    got = {r["att_pos"]: (r["rank"], r["file_name"]) for r in resolve_attachments(spark.createDataFrame(refs, REFS), index).collect()}
    by_folder = {f: sorted(n for g, n in files if g == f and n is not None) for f in ("f0", "f1", "f2", "f3")}
    for _, k, folder, nome, _ in refs:
        stem = re.sub(r"(?<=[^/])\.[^./]+$", "", nome).lower()
        exact = nome if nome in by_folder[folder] else None
        held = [n for n in by_folder[folder] if stem and stem in n.lower()]
        assert got[k] == ((2, exact) if exact else (3, held[0]) if held else (None, None)), (nome, folder)
    assert len({v[0] for v in got.values()}) == 3


def test_relevant(spark, rows):
    refs = spark.createDataFrame([("edital.pdf",), ("foto.png",), ("contrato.pdf",)], "nome string")
    assert rows(relevant_attachments(refs)) == [("edital.pdf",)]


def test_cascade_and_coverage(spark, rows):
    def tier(*names):
        return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "arquivo_json string, block_pos int")

    notices = spark.createDataFrame([(n,) for n in "abcd"], "arquivo_json string")
    asked = []

    def last(left):
        asked.append(rows(left))
        return tier("a", "b", "c", "c").join(left, "arquivo_json", "left_semi")

    items = cascade(notices, tier("a", "a", "x"), tier("a", "b"), last)
    assert rows(items, "arquivo_json", "tier") == [("a", 1), ("a", 1), ("b", 2), ("c", 3), ("c", 3)]
    assert asked == [[("c",), ("d",)]]  # a later source is asked for what is left only
    assert rows(tier_coverage(items, notices)) == [
        (0, 1, 0, 25.0), (1, 1, 2, 25.0), (2, 1, 1, 25.0), (3, 1, 2, 25.0)
    ]
    assert rows(pending(notices, items)) == [("d",)]


def test_rescue_queue(spark, rows):
    long = "é" * 130_000 + "\n" + "fim"
    texts = spark.createDataFrame(
        [("a", "x"), ("b", " \t\n"), ("c", long), ("d", "y"), ("e", None)], "arquivo_json string, text string"
    )
    solved = spark.createDataFrame([("a",), ("a",)], "arquivo_json string")
    queue = rescue_queue(texts, solved)
    assert rows(queue.select("arquivo_json", "trecho", F.length("text"))) == [("c", 0, 120_000), ("c", 1, 10_004), ("d", 0, 1)]
    assert "".join(r["text"] for r in queue.where("arquivo_json = 'c'").orderBy("trecho").collect()) == long
    answers = spark.createDataFrame([("c", None, None), ("d", 1, "x")], "arquivo_json string, trecho int, raw string")
    assert rows(unanswered(queue, answers, ["arquivo_json"]), "arquivo_json", "trecho") == [("c", 1), ("d", 0)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_pieces_lose_nothing(spark, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab é🙂\n\r") for _ in range(rng.randrange(0, 40))) for _ in range(60)] + ["\n" * 9, "x" * 9, "\n", ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for k, pieces in df.select("k", cut_text(F.col("t"), size)).collect():
        assert "".join(pieces) == texts[k] and all(0 < len(p) <= size for p in pieces)
        for piece, after in zip(pieces, pieces[1:]):
            assert piece.endswith("\n") or "\n" not in piece and len(piece) == size
            assert len(piece) + len(after) > size or "\n" in after or len(after) == size or after == pieces[-1]
    parts = spark.createDataFrame([("a", 1, "c\nd"), ("a", 0, "a\nb")], "k string, part_no int, text string")
    found = rescue_pieces(parts, 2).orderBy("trecho").collect()
    assert "".join(r["text"] for r in found) == "a\nbc\nd"


def test_answers_to_pieces_are_one_list(spark, rows):
    def said(*items):
        return json.dumps([{"item": i, "objeto": f"o{i}", "quantidade": 1, "unidade_fornecimento": "UN"} for i in items])

    answers = spark.createDataFrame(
        [("a", 0, 0, said()), ("a", 1, 2, said(1)), ("a", 1, 0, said(5, 3)), ("a", 1, 1, said(0)), ("a", 1, 10, said(2)), ("a", 2, 0, said(9)), ("b", 0, None, said(4)), ("c", 0, 0, None)],
        "arquivo_json string, att_pos int, trecho bigint, raw string",
    )
    items = rescued_items(answers, ["arquivo_json", "att_pos"]).orderBy("arquivo_json", "block_pos").collect()
    assert [(r["arquivo_json"], r["item"]) for r in items] == [("a", 5), ("a", 3), ("a", 1), ("a", 2), ("b", 4)]
    whole = rescued_items(answers.drop("trecho").where("att_pos = 2"), ["arquivo_json", "att_pos"])
    assert rows(whole, "item", "block_pos") == [(9, 0)]


def test_first_nonempty(spark, rows):
    df = spark.createDataFrame([("a", 3, 0), ("a", 1, 0), ("a", 1, 1), ("b", 2, 0)], "arquivo_json string, att_pos int, p int")
    assert rows(first_nonempty(df), "arquivo_json", "att_pos", "p") == [("a", 1, 0), ("a", 1, 1), ("b", 2, 0)]


ITEM = {"lote": "G1", "item": 1, "objeto": "Pá", "quantidade": 2, "unidade_fornecimento": "Par"}


@pytest.mark.parametrize(
    "raw, expected",
    [
        (json.dumps({"itens": [ITEM]}), [("G1", 1, "Pá", 2, "Par")]),
        ("```json\n" + json.dumps([ITEM]) + "\n```", [("G1", 1, "Pá", 2, "Par")]),
        ("  ```\n" + json.dumps([ITEM, {**ITEM, "item": 2}], indent=1) + "```  ",
         [("G1", 1, "Pá", 2, "Par"), ("G1", 2, "Pá", 2, "Par")]),
        (json.dumps([{**ITEM, "lote": None, "item": "10", "quantidade": 10.0, "extra": [1]}]), [(None, 10, "Pá", 10, "Par")]),
        (json.dumps([{k: v for k, v in ITEM.items() if k != "lote"}]), [(None, 1, "Pá", 2, "Par")]),
        (json.dumps([{**ITEM, "quantidade": True}]), [("G1", 1, "Pá", 1, "Par")]),
        (json.dumps([ITEM, {**ITEM, "item": 0}]), []),
        (json.dumps([ITEM, {**ITEM, "quantidade": 1.5}]), []),
        (json.dumps([ITEM, {**ITEM, "lote": 1}]), []),
        (json.dumps([ITEM, {**ITEM, "objeto": None}]), []),
        (json.dumps([ITEM, {k: v for k, v in ITEM.items() if k != "unidade_fornecimento"}]), []),
        (json.dumps([ITEM, "x"]), []),
        (json.dumps({"itens": []}), []),
        (json.dumps({"outro": 1}), []),
        (json.dumps({"itens": None}), []),
        ("3", []),
        ("não sei", []),
        ("", []),
        (None, []),
    ],
)
def test_answers(spark, rows, raw, expected):
    df = spark.createDataFrame([("n", raw)], "k string, raw string")
    assert rows(parse_rescue_answers(df, ["k"]).drop("k", "block_pos")) == expected


def test_table_to_markdown(spark, rows):
    cells = [
        ("d", 0, 0, 0, None), ("d", 0, 0, 1, "  "),
        ("d", 0, 2, 0, "Item"), ("d", 0, 2, 1, " Descrição\nlonga "), ("d", 0, 2, 2, "Qtd"),
        ("d", 0, 3, 2, "5"), ("d", 0, 3, 0, "1"), ("d", 0, 3, 1, "Notebook | i7"),
        ("d", 0, 4, 0, "fim"),
        ("d", 1, 0, 0, ""), ("e", 0, 0, 0, "só"),
    ]
    df = spark.createDataFrame(cells, "doc string, table_no int, row_no int, col_no int, text string")
    assert rows(table_to_markdown(df)) == [
        ("d", 0, 0, "| Item | Descrição longa | Qtd |\n| --- | --- | --- |\n| 1 | Notebook | i7 | 5 |\n| fim |  |  |"),
        ("e", 0, 0, "| só |\n| --- |"),
    ]
    assert "".join(r["markdown"] for r in table_to_markdown(df, part_chars=9).where("table_no = 0 AND doc = 'd'").orderBy("part_no").collect()).endswith("|\n| fim |  |  |")


def test_pages_and_blocks(spark, rows):
    pages = spark.createDataFrame(
        [("d", 1, " a "), ("d", 2, "b"), ("d", 3, None), ("d", 4, " "), ("d", 10, "z")], "doc string, page_no int, text string"
    )
    tables = spark.createDataFrame(
        [("d", 2, 1, "|2|"), ("d", 2, 0, "|1|"), ("d", 4, 0, "")],
        "doc string, page_no int, table_no int, markdown string",
    )
    assert rows(assemble_pages(pages, tables), "markdown") == [
        ("### Página 1\na\n\n### Página 2\n\n|1|\n\n|2|\n\n**Contexto da Página 2:**\nb\n\n### Página 4\n\n### Página 10\nz",)
    ]
    blocks = spark.createDataFrame([("d", 2, " b "), ("d", 1, "a"), ("d", 3, "\t"), ("d", 4, None)], "doc string, block_no int, text string")
    assert rows(assemble_blocks(blocks)) == [("d", 0, "a\n\nb")]


def test_sheets_and_text_documents(spark, rows):
    cells = spark.createDataFrame(
        [
            ("d", 0, 0, 0, " a ", 1), ("d", 0, 0, 1, "", 1), ("d", 0, 0, 2, "", 7), ("d", 0, 0, 3, "b", 3),
            ("d", 0, 1, 0, "", 99), ("d", 0, 2, 0, " ", 1), ("d", 1, 0, 0, "c", 1),
        ],
        "doc string, table_no int, row_no int, col_no int, text string, repeat int",
    )
    sheets = spark.createDataFrame([("d", 0, "Plan1"), ("d", 1, ""), ("d", 2, "Vazia")], "doc string, table_no int, name string")
    text = "\n### Tabela: Plan1\n| a |  | b |\n| c |\n\n### Tabela: Vazia"
    assert rows(sheets_to_text(cells, sheets), "part_no", "text") == [(0, text)]
    parts = sheets_to_text(cells, sheets, part_chars=10).orderBy("part_no").collect()
    assert len(parts) == -(-len(text) // 10) and "".join(p["text"] for p in parts) == text

    blocks = spark.createDataFrame(
        [("d", 0, " título "), ("d", 2, "x"), ("d", 3, "y"), ("d", 4, " "), ("d", 5, "fim")], "doc string, block_no int, text string"
    )
    grid = spark.createDataFrame([("d", 1, 0, 0, "x"), ("d", 1, 0, 1, "y"), ("d", 1, 1, 0, " ")], "doc string, block_no int, row_no int, col_no int, text string")
    assert rows(text_docs_to_text(blocks, grid), "text") == [("título\n| x | y |\nx\ny\nfim",)]


def notice(name="n.json", estado="PR", itens=((None, 1, "Pá", 2, "Par"),), **kw):
    row = dict(arquivo_json=name, numero_pregao="PE/1", orgao="Órgão", cidade="Lapa", estado=estado,
               anexos_processados=["e.pdf"], itens_extraidos=list(itens))
    return tuple({**row, **kw}.values())


def test_validation(spark, rows):
    df = spark.createDataFrame(
        [
            notice("a"), notice("b", itens=()), notice("c", itens=(("G1", 1, "x", 1, "y"), (None, 2, "x", 1, "y"))),
            notice("d", "pr"), notice("e", "PRR"), notice("f", None), notice("g", "PR\n"), notice("h", orgao=None),
            notice("i", itens=((None, 0, "x", 1, "y"),)), notice("j", itens=((None, 1, "x", None, "y"),)),
        ],
        PROCESSED_NOTICE,
    )
    assert rows(validation_summary(df)) == [(10, 3, 3, 1, 30.0, pytest.approx(100 / 3))]
    assert {r["arquivo_json"]: r["motivos"] for r in rejects(df).collect()} == {
        "d": ["estado: não são duas maiúsculas"],
        "e": ["estado: não são duas maiúsculas"],
        "f": ["estado: ausente"],
        "g": ["estado: não são duas maiúsculas"],
        "h": ["orgao: ausente"],
        "i": ["itens_extraidos: item inválido"],
        "j": ["itens_extraidos: item inválido"],
    }
    empty = df.where(F.lit(False))
    assert rows(validation_summary(empty)) == [(0, 0, 0, 0, 0.0, 0.0)]


def test_scoring(spark, rows):
    gold_items = ((None, 1, "Mesa de madeira maciça", 2, "Unidade"), (" G1 ", 2, "Pá", 3, "Par"), (None, 3, "x", 1, "y"))
    pred_items = ((None, 1, "Mesa de madeira macica", 2, " unidade"), ("G1", 2, "Enxada", 3, "Par"))
    pred = spark.createDataFrame([notice("a", itens=pred_items), notice("b"), notice("c", itens=())], PROCESSED_NOTICE)
    gold = spark.createDataFrame(
        [notice("a", itens=()) + (0,), notice("a", itens=gold_items) + (1,), notice("c") + (2,)],
        f"{PROCESSED_NOTICE}, pos int",
    )
    result = evaluate(pred, gold)
    assert rows(result.accuracy) == sorted(
        [("todos", 1, 2, 50.0), ("item", 2, 2, 100.0), ("quantidade", 2, 2, 100.0), ("lote", 2, 2, 100.0),
         ("objeto", 1, 2, 50.0), ("unidade_fornecimento", 2, 2, 100.0)], key=repr
    )
    assert rows(result.compared, "arquivo_json", "pos", "ok_objeto", "ok_todos") == [
        ("a", 0, True, True), ("a", 1, False, False)
    ]
    nothing = accuracy_summary(compare_items(align_items(*[spark.createDataFrame([], "arquivo_json string, pos int, lote string, item bigint, objeto string, quantidade bigint, unidade_fornecimento string")] * 2)))
    assert all(r["pct"] == 0.0 for r in nothing.collect())


def test_scoring_of_notices_in_parts_equals_that_of_whole_ones(spark, rows):
    """Seven items in parts of three score as they do in one row."""
    def item(n, lote=None):
        return (lote, n, f"Mesa de madeira {n}", 2, "Par")

    whole_gold = [("a", [item(n) for n in range(1, 9)], 4), ("b", [item(1)], 2), ("a", [item(9)], 1)]
    whole_pred = [("a", [item(n, "G1" if n == 5 else None) for n in range(1, 8)]), ("b", [item(2)])]

    def frame(lists, size, pos=False):
        out = []
        for name, items, *at in lists:
            for k in range(0, max(1, len(items)), size):
                out.append(notice(name, itens=items[k : k + size]) + (k // size, *at))
        return spark.createDataFrame(out, f"{PROCESSED_NOTICE}, parte bigint{', pos int' if pos else ''}").repartition(3)

    found = []
    for size in (100, 3, 1):
        result = evaluate(frame(whole_pred, size), frame(whole_gold, size, pos=True))
        found.append((rows(result.accuracy), rows(result.summary), rows(result.compared, "arquivo_json", "pos", "ok_lote", "ok_todos")))
    assert found[0] == found[1] == found[2]
    assert ("todos", 6, 8, 75.0) in found[0][0] and found[0][1] == [(2, 2, 8, 1, 100.0, 12.5)]
    flat = evaluate_items(*[df.select("arquivo_json", "att_pos", "block_pos", "lote", "item", "objeto", "quantidade", "unidade_fornecimento")
                            for df in (item_rows(frame(whole_pred, 3)).withColumns({"att_pos": F.lit(0), "block_pos": F.col("pos") * 10}),
                                       item_rows(frame([g[:2] for g in whole_gold[:2]], 3)).withColumns({"att_pos": F.lit(0), "block_pos": F.col("pos") * 7}))])
    assert rows(flat[1]) == found[0][0]


def test_an_invalid_part_makes_its_notice_invalid(spark, rows):
    parts = [notice("a") + (0,), notice("a", itens=((None, 0, "x", 1, "y"),)) + (1,), notice("b") + (0,), notice("b") + (1,)]
    df = spark.createDataFrame(parts, f"{PROCESSED_NOTICE}, parte bigint")
    assert rows(validation_summary(df)) == [(2, 1, 2, 0, 50.0, 0.0)]


def test_scoring_nulls(spark):
    side = "arquivo_json string, pos int, lote string, item bigint, objeto string, quantidade bigint, unidade_fornecimento string"
    pred = spark.createDataFrame([("a", 0, None, None, None, 1, None)], side)
    gold = spark.createDataFrame([("a", 0, None, None, "none", 1, "NONE")], side)
    row = compare_items(align_items(pred, gold)).first()
    assert (row["ok_item"], row["ok_quantidade"], row["ok_lote"], row["ok_objeto"], row["ok_unidade_fornecimento"]) == (
        False, True, True, True, True)


def test_dedupe_last(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 3), ("a", "y", 2), ("b", "z", 0)], "arquivo_json string, v string, pos int")
    assert rows(dedupe_last(df), "arquivo_json", "v", "pos") == [("a", None, 3), ("b", "z", 0)]


def test_nesting(spark, rows):
    schema = "arquivo_json string, att_pos int, block_pos bigint, lote string, item bigint, objeto string, quantidade bigint, unidade_fornecimento string"
    data = [("a", a, b, None, 10 * a + b, "o", 1, "u") for a in (1, 0) for b in (2, 0, 1, 5)] + [("b", 0, 0, "G1", 1, "o", 1, "u")]
    items = spark.createDataFrame(data, schema)
    whole = nest_items(items).where("arquivo_json = 'a'").collect()
    order = [0, 1, 2, 5, 10, 11, 12, 15]
    assert [i["item"] for i in whole[0]["itens_extraidos"]] == order and whole[0]["parte"] == 0
    parts = nest_items(items, part_rows=3).where("arquivo_json = 'a'").orderBy("parte").collect()
    assert [[i["item"] for i in p["itens_extraidos"]] for p in parts] == [order[:3], order[3:6], order[6:]]
    assert [p["parte"] for p in parts] == [0, 1, 2]
    headers = spark.createDataFrame([notice(n)[:5] for n in ("a", "b", "c")], ", ".join(PROCESSED_NOTICE.replace("\n", " ").split(", ")[:5]))
    attachments = spark.createDataFrame([("a", ["x", "y"])], "arquivo_json string, anexos_processados array<string>")
    nested = {r["arquivo_json"]: r for r in nest_notices(headers, attachments, items).collect()}
    assert len(nested["a"]["itens_extraidos"]) == 8 and nested["a"]["anexos_processados"] == ["x", "y"]
    assert nested["c"]["itens_extraidos"] == [] and nested["c"]["anexos_processados"] == []


def test_rate_limit_streaks_equal_brute_force(spark):
    rng = random.Random(3)
    kinds = [(True, None), (False, "429"), (False, "too many requests"), (False, "500"), (False, "401")]
    log, expected = [], {}
    for session in ("s", "t"):
        streak = 0
        for call in range(300):
            ok, error = rng.choices(kinds, [1, 3, 2, 2, 1])[0]
            limited = error in ("429", "too many requests")
            streak = 0 if ok else streak + limited
            log.append((session, call * 3, ok, error))
            expected[session, call * 3] = (streak, limited and streak >= 2)
    rng.shuffle(log)
    df = spark.createDataFrame(log, "s string, call_id bigint, ok boolean, error string")
    sparse = df.withColumn("call_id", F.struct("call_id", F.xxhash64("call_id").alias("h")))  # any type that has an order
    hashed = df.withColumn("call_id", F.col("call_id") * 1_000_003 * 9_999_991)
    for log_ids, back in ((df, F.col("call_id")), (sparse, F.col("call_id.call_id")), (hashed, (F.col("call_id") / 1_000_003 / 9_999_991).cast("bigint"))):
        got = {(r["s"], r["id"]): (r["sequencia"], r["disparo"]) for r in rate_limit_streaks(log_ids.repartition(6), ["s"]).withColumn("id", back).collect()}
        assert got == expected
    one = df.where("s = 's'").drop("s")
    for log_ids in (one, one.repartition(7)):
        got = {("s", r["call_id"]): (r["sequencia"], r["disparo"]) for r in rate_limit_streaks(log_ids).collect()}
        assert got == {k: v for k, v in expected.items() if k[0] == "s"}


def test_streaks_and_positions_are_counted_in_tasks(spark):
    """Ids with gaps of any width: every task numbers its own range, none gets all rows."""
    ids = spark.range(0, 20_000, numPartitions=8).select(F.xxhash64("id").alias("call_id"), (F.col("id") % 97 == 0).alias("ok"), F.lit("429").alias("error"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows_of_task = numbered(ids, ["call_id"]).groupBy(task_of().alias("t")).count().collect()
        assert len(rows_of_task) == 4 and max(r["count"] for r in rows_of_task) < 7_000
        placed = dense_positions(ids, [], ["call_id"]).select("pos", F.rank().over(Window.orderBy("call_id")).alias("r"))
        assert placed.where("pos <> r - 1").isEmpty() and placed.count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_positions_and_running_totals(spark, rows):
    df = spark.createDataFrame([(k, v, w) for k in ("a", None, "b") for v, w in ((5, 2), (-9, 1), (5, 2), (None, 4), (10**15, 3))], "k string, v bigint, w int").repartition(4)
    expected = {(k, 0, None) for k in ("a", "b", None)} | {(k, p, v) for k in ("a", "b", None) for p, v in ((1, -9), (2, 5), (3, 5), (4, 10**15))}
    assert set(rows(dense_positions(df, ["k"], ["v"]), "k", "pos", "v")) == expected
    totals = rows(running_totals(df, ["k"], ["v"], "w"), "k", "before")
    assert sorted(b for k, b in totals if k is None) == sorted(b for k, b in totals if k == "a") == [0, 4, 5, 7, 9]
