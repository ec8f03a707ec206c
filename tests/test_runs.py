"""Sources, sinks, the batch run with resume, and the stream."""

import contextlib
import io
import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bidlines.operators.attachments import resolve_attachments
from bidlines.operators.cascade import first_nonempty, pending, unsolved
from bidlines.plans.extract import ITEMS, read_finished, run_batch
from bidlines.schemas import ANSWERS, FAILURE, ITEM_ROWS, PAGES, PROCESSED_NOTICE
from bidlines.sources.files import _lister, read_file_index
from bidlines.sources.layout import by_notice, write_by_notice
from bidlines.sources.notices import explode_attachments, notice_header, read_notices
from bidlines.sources.results import (
    export_json,
    failure_report_lines,
    read_checkpoint,
    read_table,
    write_failures,
    write_failure_report,
    write_manifest,
    write_results,
)
from bidlines.sources.shared import cut_lineage, new_path, shared_dir
from bidlines.streaming.incremental import run_incremental

TEXT = "1 - Pá\r\nPá larga\r\nQuantidade: 3\r\nUnidade de fornecimento: Par\r\n----------\r\n2 - Mesa\r\nQuantidade: 4"


def ref(nome, caminho=None):
    return {"nome": nome, "formato": "pdf", "url": "u", "caminho": caminho or f"s3://b/{nome}", "hash_content": "h"}


def data(**kw):
    return {"data": {"numero_pregao": "PE/1", "orgao": "Órgão", "cidade": "Lapa", "estado": "pr", "itens": [TEXT], "anexos": [], **kw}}


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "downloads"
    root.mkdir()
    notices = {
        "a.json": data(anexos=[ref("edital.pdf"), ref("foto.png"), ref("vazio.pdf"), ref("some.pdf")]),
        "b.json": data(anexos=[ref("termo.docx"), ref("relacao.pdf")]),
        "c.json": data(),
        "d.json": data(itens=[""], estado="sp"),
        "e.json": data(estado=None),
        "f.json": data(anexos=None),
        "g.json": data(anexos=[{"nome": None}]),
        "i.json": {"data": {"orgao": 12, "estado": "RJ"}},
        "j.json": {"outro": 1},
    }
    for name, notice in notices.items():
        (root / name).write_text(json.dumps(notice, ensure_ascii=False), encoding="utf-8")
    (root / "h.json").write_text('{"data": {"orgao": ', encoding="utf-8")
    (root / "leia.txt").write_text("x")
    for name, size in {"a/edital.pdf": 3, "a/vazio.pdf": 0, "b/x-termo-9.docx": 2, "b/relacao.pdf": 1, "b/sub/fundo.pdf": 1}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)
    return root


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [
            ("a.json", 0, 1, "Composição dos Grupos\nG1\nItem 1\n1 - A A A A\nDescrição Detalhada: b"),
            ("a.json", 0, 2, "Quantidade Total: 7\nUnidade de Fornecimento: Par..,"),
            ("a.json", 2, 1, "5 - Nunca\nQuantidade: 1"),
            ("b.json", 0, 1, "6 - Só pdf conta\nQuantidade: 1"),
            ("b.json", 1, 1, "sem itens"),
        ],
        PAGES,
    )


@pytest.fixture
def answers(spark):
    item = '[{"item": %d, "objeto": "x x y", "quantidade": 2, "unidade_fornecimento": "Cx"}]'
    return spark.createDataFrame(
        [("a.json", 0, item % 1), ("b.json", 0, "[]"), ("b.json", 1, item % 9), ("c.json", 0, item % 8)], ANSWERS
    )


def test_notice_scan(spark, rows, folder):
    notices = read_notices(spark, str(folder))
    header = {r["arquivo_json"]: r for r in notice_header(notices).collect()}
    assert sorted(header) == [f"{n}.json" for n in "abcdefghij"]
    assert header["a.json"]["estado"] == "PR" and header["a.json"]["itens"] == [TEXT]
    assert header["e.json"]["estado"] == "NONE"
    assert (header["i.json"]["orgao"], header["i.json"]["cidade"]) == ("12", "")
    assert {n: r["ilegivel"] for n, r in header.items() if r["ilegivel"]} == {
        "f.json": ["anexos: nulo"], "g.json": ["anexos.nome: nulo"], "h.json": ["arquivo: JSON inválido"],
    }
    assert rows(explode_attachments(notices), "arquivo_json", "att_pos", "folder", "nome", "caminho")[:2] == [
        ("a.json", 0, "a", "edital.pdf", "s3://b/edital.pdf"), ("a.json", 1, "a", "foto.png", "s3://b/foto.png"),
    ]


def test_bundled_notices(spark, rows, tmp_path):
    lines = [{"arquivo_json": f"{n}.json", **data(cidade=n)} for n in "ab"]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, lines)))
    header = notice_header(read_notices(spark, str(tmp_path), bundled=True))
    assert rows(header, "arquivo_json", "cidade") == [("a.json", "a"), ("b.json", "b")]


def test_file_index(spark, rows, folder):
    assert rows(read_file_index(spark, str(folder)), "folder", "file_name", "length") == [
        ("a", "edital.pdf", 3), ("a", "vazio.pdf", 0), ("b", "relacao.pdf", 1), ("b", "x-termo-9.docx", 2),
    ]


A = ("G1", 1, "A b", 7, "Par")  # cleaned twice: "A A A A b" and "Par..,"
FALLBACK = [(None, 1, "Pá larga", 3, "Par"), (None, 2, "Mesa", 4, "Unidade")]
EXPECTED = {
    "a.json": ("PR", ["edital.pdf"], [A]),
    "b.json": ("PR", ["termo.docx", "relacao.pdf"], [(None, 9, "x y", 2, "Cx")]),
    "c.json": ("PR", [], FALLBACK),
    "d.json": ("SP", [], []),
    "i.json": ("RJ", [], []),
}


def results(spark, out):
    df = spark.read.parquet(f"{out}/licitacoes")
    return {r["arquivo_json"]: (r["estado"], r["anexos_processados"], [tuple(i) for i in r["itens_extraidos"]]) for r in df.collect()}


def test_small_folders_are_listed_in_one_piece(tmp_path):
    for k in range(5):
        (tmp_path / f"s={k}").mkdir()
        (tmp_path / f"s={k}" / "part-0.txt").write_bytes(b"x" * k)
    (tmp_path / "s=0" / "part-0.txt").unlink()
    (found,) = _lister(str(tmp_path))(iter([pd.DataFrame({"folder": [f"s={k}" for k in range(6)]})]))
    assert found["folder"].tolist() == [f"s={k}" for k in range(5)]
    assert found["length"].isna().tolist() == [True] + [False] * 4 and found["length"].sum() == 10


def test_batch_run(spark, rows, folder, pages, answers, tmp_path):
    out = str(tmp_path / "out")
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r1")
    assert results(spark, out) == EXPECTED
    assert rows(spark.read.parquet(f"{out}/falhas"), "arquivo_json", "anexo", "motivo") == [
        ("a.json", "some.pdf", f"Arquivo anexo 'some.pdf' não foi encontrado em {folder}/a"),
        ("a.json", "vazio.pdf", "Arquivo corrompido ou vazio (0 bytes): vazio.pdf"),
    ]
    refused = {r["arquivo_json"]: r["motivos"] for r in spark.read.parquet(f"{out}/rejeitados").collect()}
    assert sorted(refused) == ["e.json", "f.json", "g.json", "h.json", "j.json"]
    assert "arquivo: JSON inválido" in refused["h.json"]
    items = read_finished(spark, out, ITEMS, ITEM_ROWS)
    assert rows(items.groupBy("tier").count()) == [(1, 1), (2, 1), (3, 2)]

    # A second run only takes what is new or was refused.
    (folder / "e.json").write_text(json.dumps(data(cidade="Nova")), encoding="utf-8")
    (folder / "k.json").write_text(json.dumps(data()), encoding="utf-8")
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r2")
    table = spark.read.parquet(f"{out}/licitacoes")
    assert rows(table, "arquivo_json", "execucao") == sorted(
        [(n, "r1") for n in EXPECTED] + [("e.json", "r2"), ("k.json", "r2")], key=repr
    )
    # Writing a run again leaves nothing twice.
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r3")
    assert table.count() == spark.read.parquet(f"{out}/licitacoes").count() == 7
    assert read_finished(spark, out, ITEMS, ITEM_ROWS).count() == 8
    # Reset drops earlier runs.
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r4", resume=False)
    assert {r["execucao"] for r in spark.read.parquet(f"{out}/licitacoes").select("execucao").distinct().collect()} == {"r4"}


def test_used_run_name_keeps_its_notices(spark, folder, pages, answers, tmp_path):
    out = str(tmp_path / "out")
    later = {name: (folder / name).read_text(encoding="utf-8") for name in ("c.json", "h.json")}
    kept = tmp_path / "first"
    kept.mkdir()
    (kept / "a.json").write_text((folder / "a.json").read_text(encoding="utf-8"), encoding="utf-8")
    run_batch(spark, str(kept), str(folder), pages, answers, out, "r1")
    for name, text in later.items():
        (kept / name).write_text(text, encoding="utf-8")
    run_batch(spark, str(kept), str(folder), pages, answers, out, "r1")
    done = spark.read.parquet(f"{out}/licitacoes")
    assert sorted(r["arquivo_json"] for r in done.collect()) == ["a.json", "c.json"]
    # What the run wrote about notices that left the folder stays; the others are done again.
    failures, refusals = (spark.read.parquet(f"{out}/{t}").count() for t in ("falhas", "rejeitados"))
    (kept / "a.json").unlink()
    (kept / "h.json").unlink()
    run_batch(spark, str(kept), str(folder), pages, answers, out, "r1")
    assert sorted(r["arquivo_json"] for r in spark.read.parquet(f"{out}/licitacoes").collect()) == ["a.json", "c.json"]
    assert {r["arquivo_json"] for r in spark.read.parquet(f"{out}/itens").collect()} == {"a.json", "c.json"}
    assert (failures, refusals) == tuple(spark.read.parquet(f"{out}/{t}").count() for t in ("falhas", "rejeitados")) and refusals == 1


def results_of_finished_runs(spark, out):
    return {r["arquivo_json"] for r in read_finished(spark, out, "licitacoes", PROCESSED_NOTICE).collect()}


def test_only_buckets_of_the_notices_are_read(spark, rows, pages, tmp_path):
    many = pages.unionByName(spark.range(400).selectExpr("concat(id, '.json') AS arquivo_json", "0 AS att_pos", "1 AS page_no", "'x' AS text"))
    write_by_notice(many, str(tmp_path / "p"), buckets=32)
    wanted = spark.createDataFrame([("a.json",), ("zz.json",)], "arquivo_json string")
    some = by_notice(spark, str(tmp_path / "p"), PAGES, buckets=32)(wanted)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        some.explain()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan.getvalue())[1]
    assert "balde" in filters and filters.count(",") <= 3
    keys = rows(some.join(wanted, "arquivo_json", "left_semi"), "arquivo_json", "att_pos", "page_no")
    assert keys == [("a.json", 0, 1), ("a.json", 0, 2), ("a.json", 2, 1)]
    assert some.count() < 60


def test_void_checkpoint_keeps_failures_and_refusals(spark, folder, pages, answers, tmp_path):
    out = str(tmp_path / "out")
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r1")
    before = {t: spark.read.parquet(f"{out}/{t}").count() for t in ("falhas", "rejeitados")}
    bad = spark.createDataFrame([(None, "1", "o", "c", "PR", [], [])], PROCESSED_NOTICE)
    write_results(bad, f"{out}/licitacoes", "bad")
    assert results_of_finished_runs(spark, out) == set(EXPECTED)  # a run without a manifest has not ended
    write_manifest(spark, f"{out}/licitacoes", f"{out}/manifesto", "bad")
    run_batch(spark, str(folder), str(folder), pages, answers, out, "r2")
    assert min(before.values()) > 0
    for t, n in before.items():
        assert spark.read.parquet(f"{out}/{t}").where("execucao = 'r1'").count() == n
    assert spark.read.parquet(f"{out}/licitacoes").where("execucao <> 'r2'").isEmpty()


def test_sides_of_a_row_per_notice_are_not_broadcast(spark):
    refs = spark.range(9).selectExpr("id || '.json' AS arquivo_json", "0 AS att_pos", "string(id) AS folder", "'a.pdf' AS nome", "'x' AS caminho")
    files = spark.range(9).selectExpr("string(id) AS folder", "'a.pdf' AS file_name", "'p' AS path", "1L AS length")
    resolved = resolve_attachments(refs, files)
    for df in (resolved, pending(refs, refs), first_nonempty(refs), unsolved(refs, resolved)):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        assert "Join" in out.getvalue() and "Broadcast" not in out.getvalue()


def test_json_of_a_run_is_parsed_once(spark, folder, pages, answers, tmp_path, monkeypatch):
    from bidlines.plans import extract as plan

    seen, extract = [], plan.extract
    monkeypatch.setattr(plan, "extract", lambda notices, *more: seen.append(notices) or extract(notices, *more))
    for _ in range(2):
        plan.run_batch(spark, str(folder), str(folder), pages, answers, str(tmp_path / "out"), "r1")
    for notices in seen:
        read = notices._jdf.queryExecution().executedPlan().toString().lower()
        assert "scan parquet" in read and "scan json" not in read


def test_unread_fields_may_hold_anything(spark, rows, tmp_path):
    odd = {"numero_habitantes": "1000", "orgao_sites": "www.x", "boletim_id": "7"}
    notices = {"a": data(**odd), "b": data(anexos={"nome": "x.pdf"}), "c": data(anexos=[None]), "d": data(anexos=["x.pdf"]), "e": data(anexos={}), "f": data(anexos=3)}
    for name, notice in notices.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(notice), encoding="utf-8")
    header = notice_header(read_notices(spark, str(tmp_path)))
    assert {r["arquivo_json"][0]: r["ilegivel"] for r in header.collect()} == {
        "a": [], "e": [], **{k: ["anexos: inválido"] for k in "bcdf"}
    }


def test_stream_run(spark, rows, folder, pages, answers, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def go():
        query = run_incremental(spark, str(folder), str(folder), pages, answers, out, ckpt, max_files_per_trigger=4)
        assert query.awaitTermination(300)

    go()
    assert results(spark, out) == EXPECTED
    assert spark.read.parquet(f"{out}/licitacoes").select("execucao").distinct().count() >= 2
    (folder / "k.json").write_text(json.dumps(data()), encoding="utf-8")
    go()
    assert results(spark, out) == {**EXPECTED, "k.json": ("PR", [], FALLBACK)}
    # The batch form then retries what the stream refused.
    (folder / "e.json").write_text(json.dumps(data()), encoding="utf-8")
    run_batch(spark, str(folder), str(folder), pages, answers, out, "retry")
    assert results(spark, out) == {**EXPECTED, "k.json": ("PR", [], FALLBACK), "e.json": ("PR", [], FALLBACK)}


def test_checkpoint_is_void_with_one_bad_row(spark, tmp_path):
    row = ("a", "1", "o", "c", "PR", [], [(None, 1, "x", 1, "u")])
    good = spark.createDataFrame([row], PROCESSED_NOTICE)
    bad = spark.createDataFrame([("b", *row[1:4], "pr", *row[5:])], PROCESSED_NOTICE)
    path = str(tmp_path / "t")
    assert read_checkpoint(spark, path).isEmpty()
    write_results(good, path, "r1")
    assert read_checkpoint(spark, path).count() == 1
    write_results(bad, path, "r2")
    assert read_checkpoint(spark, path).isEmpty()
    write_results(good, path, "r3", reset=True)
    assert read_checkpoint(spark, path).count() == 1
    export_json(good.unionByName(good.withColumn("arquivo_json", F.lit("0"))), str(tmp_path / "json"))
    back = read_table(spark, str(tmp_path / "json"), PROCESSED_NOTICE, "json")
    assert [r["arquivo_json"] for r in back.orderBy("arquivo_json").collect()] == ["0", "a"]
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "json").glob("part*")))
    assert '"lote":null' in text


def test_failure_report(spark, tmp_path):
    rows = spark.createDataFrame(
        [("pregao-77.json", "planilha.pdf", "Sem texto (3 páginas)")], "arquivo_json string, anexo string, motivo string"
    )
    write_failures(rows, str(tmp_path / "f"), "r1")
    stamped = read_table(spark, str(tmp_path / "f"), FAILURE)
    block = failure_report_lines(stamped).first()["value"].split("\n")
    assert len(block) == 5 and block[0].startswith("- **Data/Hora:** 20") and block[4] == ""
    assert block[1:4] == [
        "- **Arquivo JSON Origem:** pregao-77.json",
        "- **Anexo Falho:** planilha.pdf",
        "- **Motivo:** Sem texto (3 páginas)",
    ]
    write_failure_report(stamped, str(tmp_path / "report"))
    report = "".join(p.read_text() for p in (tmp_path / "report").glob("part*"))
    assert report.endswith("(3 páginas)\n\n")


def test_shared_folder(spark):
    base = shared_dir(spark)
    assert new_path(spark, "x").startswith(base) and new_path(spark, "x") != new_path(spark, "x")
    assert cut_lineage(spark.range(3)).count() == 3
