import pytest
from pyspark.sql import functions as F

from bidlines.functions import (
    base_name,
    clean_cell,
    clean_description,
    clean_unit,
    error_class,
    file_stem,
    is_relevant_attachment,
    percentage,
    strip,
    text_similarity,
)


@pytest.mark.parametrize(
    "raw, clean",
    [
        (None, "Unidade"),
        ("", "Unidade"),
        ("   ", "Unidade"),
        ("Caixa 50 UN", "Caixa 50 UN"),
        (" Caixa.,", "Caixa."),
        ("Caixa,.", "Caixa"),
        ("Rolo 1.", "Rolo 1"),
        ("Unidade Quantidade Máxima: 5", "Unidade"),
        ("Pacote CRITÉRIO de julgamento", "Pacote"),
        ("Metro valor 10", "Metro"),
        (" Valor 10", "Unidade"),
        ("Valor 10", "Valor 10"),
        ("Caixa Valoré", "Caixa Valoré"),
        ("Item Itemizado", "Item Itemizado"),
        ("Galão Item 2", "Galão"),
        ("Fardo Situação boa", "Fardo"),
        ("Litro\nLocal de entrega", "Litro"),
        ("a  b", "a  b"),
    ],
)
def test_clean_unit(value, raw, clean):
    assert value(clean_unit(F.lit(raw).cast("string"))) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        (None, ""),
        ("", ""),
        ("Mesa de madeira", "Mesa de madeira"),
        ("Caderno Caderno Material papel", "Caderno Material papel"),
        ("CADEIRA GIRATÓRIA cadeira giratória, cor azul", "cadeira giratória, cor azul"),
        ("A A A A", "A A"),
        ("a b a b a b", "a b a b"),
        ("- - x", "- - x"),
        ("- - - - x", "- - x"),
        ("a/b ab c", "ab c"),
        ("Mesa  \t com\r\n quatro pés", "Mesa com quatro pés"),
        ("Jogo, QUANTIDADE 51 peças", "Jogo"),
        ("Toner PREGÃO 1/2024", "Toner"),
        ("Toner pregão 1/2024", "Toner"),
        ("Item 3 do local", "Item 3 do"),
        ("Localizado aqui", "Localizado aqui"),
        ("x Localizado aqui", "x Localizado aqui"),
        ("x ,;", "x ,"),
        ("x ;,,", "x "),
        ("3 PARTES,", "3 PARTES"),
        ("um dois três quatro cinco seis sete oito nove dez um dois três quatro cinco seis sete oito nove dez fim",
         "um dois três quatro cinco seis sete oito nove dez fim"),
        ("a b c d e f g h i j k a b c d e f g h i j k", "a b c d e f g h i j k a b c d e f g h i j k"),
    ],
)
def test_clean_description(value, raw, clean):
    assert value(clean_description(F.lit(raw).cast("string"))) == clean


def test_cleaning_twice_is_not_cleaning_once(value):
    once = clean_description(F.lit("A A A A"))
    assert value(clean_description(once)) == "A"


def test_strip_all_blanks(value):
    assert value(strip(F.lit("　 \t x y \x1f\r\n"))) == "x y"


@pytest.mark.parametrize(
    "name, stem, base",
    [
        ("s3://b/x/edital.v2.pdf", "edital.v2", "edital.v2.pdf"),
        ("edital", "edital", "edital"),
        (".pdf", ".pdf", ".pdf"),
        ("a/b/", "b", "b"),
    ],
)
def test_names(value, name, stem, base):
    assert value(file_stem(F.lit(name))) == stem
    assert value(base_name(F.lit(name))) == base


@pytest.mark.parametrize(
    "name, relevant",
    [
        ("edital.pdf", True),
        ("termo_referencia.pdf", True),
        ("relacaoitens123.pdf", True),
        ("modelo_proposta.docx", True),
        ("imagem.png", False),
        ("contrato_minuta.pdf", False),
        ("EDITAL_CONTRATO.PDF", True),
        ("declaracao.ODT", False),
        ("planilha.ods", True),
        ("planilha.xls", False),
        ("pdf", False),
        ("x.pdf\n", False),
    ],
)
def test_relevant_attachment(value, name, relevant):
    assert value(is_relevant_attachment(F.lit(name))) is relevant


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("", None, 1.0),
        ("  ", "x", 0.0),
        ("Ação", " ação ", 1.0),
        ("acao", "ação", 0.5),
        ("kitten", "sitting", 1 - 3 / 7),
    ],
)
def test_similarity(value, a, b, expected):
    assert value(text_similarity(F.lit(a).cast("string"), F.lit(b).cast("string"))) == pytest.approx(expected)


@pytest.mark.parametrize(
    "error, kind",
    [
        ("Error code: 401", "auth"),
        ("403 and 429", "auth"),
        ("forbidden", "other"),
        ("Forbidden", "auth"),
        ("code 429", "rate_limit"),
        ("Rate Limit reached", "rate_limit"),
        ("Too Many Requests", "rate_limit"),
        ("model Not Found", "not_found"),
        ("404", "not_found"),
        ("timeout", "other"),
        (None, None),
    ],
)
def test_error_class(value, error, kind):
    assert value(error_class(F.lit(error).cast("string"))) == kind


def test_cell_and_percentage(value):
    assert value(clean_cell(F.lit(" a\nb "))) == "a b"
    assert value(clean_cell(F.lit(None).cast("string"))) == ""
    assert value(percentage(F.lit(1), F.lit(4))) == 25.0
    assert value(percentage(F.lit(1), F.lit(0))) == 0.0
