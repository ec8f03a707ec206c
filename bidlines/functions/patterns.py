"""Words, prefixes and character classes the results depend on.

Java regular expressions differ from the source rules in what they call blank,
line end, digit and letter, so the classes are spelled out here once and every
pattern is built from them. That also avoids the slower ``(?U)`` mode.
"""

# --- fixed values: character classes -------------------------------------------------
# Blank characters, as a set for ``btrim`` and as a regex class.
BLANKS = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
# Single Latin-1 characters and \p{Z} are the cheapest class: a bit set and one category test.
_LATIN_BLANKS = r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0"
WS = rf"[{_LATIN_BLANKS}\p{{Z}}]"
# Line ends, and blanks that are not line ends. (A range is much faster than two single characters.)
LB = r"[\n\x0B\f\r\x1C\x1D\x1E\x85\x{2028}-\x{2029}]"
NOT_LB = r"[^\n\x0B\f\r\x1C\x1D\x1E\x85\x{2028}-\x{2029}]"
HS = r"[\t\x1F\p{Zs}]"
# A word must not run on after a cut word.
WORD_END = r"(?![\p{L}\p{N}_])"
# Decimal digits, superscripts and subscripts.
DIGIT = r"[\p{Nd}\xB2\xB3\xB9\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"

# --- fixed values: words that end a unit or a description -----------------------------
UNIT_CUT_WORDS = (
    "Quantidade", "Valor", "Critério", "Tratamento", "Aplicabilidade", "Situação", "Local", "Item",
)
DESCRIPTION_CUT_WORDS = (
    "Quantidade", "Valor", "Critério", "Tratamento", "Aplicabilidade", "Situação", "Local", "PREGÃO",
)
DEFAULT_UNIT = "Unidade"

# --- fixed values: lines that are no part of a description ----------------------------
NOTICE_SKIP_PREFIXES = ("Tratamento", "Aplicabilidade", "Quantidade:", "Unidade de fornecimento:")
ATTACHMENT_SKIP_PREFIXES = (
    "Tratamento", "Aplicabilidade", "Quantidade", "Critério", "Valor", "Unidade", "Intervalo", "Local", "PREGÃO",
)
DETAIL_LABEL = "Descrição Detalhada:"

# --- fixed values: attachment names ----------------------------------------------------
RELEVANT_EXTENSIONS = ("pdf", "docx", "odt", "ods")
BLOCKED_NAME_WORDS = ("contrato", "planilha_custos", "ata_registro", "declaracao", "proposta_de_preco")
OVERRIDE_NAME_WORDS = ("edital", "termo", "relacao")

# --- fixed values: limits --------------------------------------------------------------
TITLE_WORDS = 10            # longest repeated title that is removed
RESCUE_CHARS = 120_000      # longest text sent to a model at once
SIMILARITY_PASS = 0.85      # description similarity that counts as equal
RATE_LIMIT_STREAK = 2       # rate limits in a row that open the breaker
STRIPPED_PUNCTUATION = ".,/;-"

# --- fixed values: failure reasons -----------------------------------------------------
REASON_NO_FOLDER = "Pasta de anexos não encontrada: "
REASON_NO_FILE = ("Arquivo anexo '", "' não foi encontrado em ")
REASON_EMPTY_FILE = "Arquivo corrompido ou vazio (0 bytes): "

# --- fixed values: markers in call errors ------------------------------------------------
AUTH_MARKERS = ("401", "403", "invalid_api_key", "Unauthorized", "Forbidden")

# --- item text ---------------------------------------------------------------------------
# Fixed labels, matched in any case. (Their first letter as a class is much faster to look for; no other letter folds to it.)
ITEM_START = rf"\n(?=\d+{WS}*-)"
# Five dashes or more, or ITEM_START; the class first, so that most characters are passed by at once.
NOTICE_SPLIT = rf"[-\n](?:(?<=-)-{{4,}}|(?<=\n)(?=\d+{WS}*-))"
NOTICE_HEADER = rf"(?dm)^(\d+){WS}*-{WS}*([^\n]+)"
ATTACHMENT_HEADER = rf"\A(\d+){WS}*-{WS}*([^\n]+)"
# What NOTICE_HEADER and ATTACHMENT_HEADER match is their match again under ATTACHMENT_HEADER; with a number that is POSITIVE.
POSITIVE_HEAD = r"\A0*[1-9]\d{0,18}(?!\d)"
POSITIVE = r"\A0*[1-9]\d{0,18}\z"
NOTICE_QUANTITY = rf"[Qq](?iu:uantidade:){WS}*(\d+)"
ATTACHMENT_QUANTITY = rf"[Qq](?iu:uantidade)(?:{WS}*(?iu:Total))?:{WS}*(\d+)"
QUANTITY_WORD = r"[Qq](?iu:uantidade)"  # in every block that is an item
SUPPLY_UNIT = rf"[Uu](?iu:nidade de fornecimento:){WS}*([^\n]+)"
INLINE_GROUP = rf"(?=[GgLl])(?iu:Grupo|Lote):{WS}*([Gg]?\d+)"
GROUP_HEADING = rf"[Cc](?iu:omposição dos Grupos){WS}*\n"
GROUP_SECTION_END = rf"\n{WS}*\d+{WS}*-"
GROUP_SECTION = rf"{GROUP_HEADING}((?s:.*?))(?={GROUP_SECTION_END}|\z)"
GROUP_BLOCK = rf"G\d+{WS}*\n(?s:.*?)(?=\n{WS}*G\d+|\z)"
GROUP_NAME = r"\A(G\d+)"
GROUP_ITEM = rf"(?=[Iiıİ])(?iu:Item){WS}*(\d+)"
# Lines that neither name a group nor an item, are not blank, and don't begin with a number or dash, which may go on with the line before.
GROUP_IDLE_LINES = rf"(?:\n(?!{WS}*(?:[\d-]|\z))(?![^\n]*G\d)(?![^\n]*(?iu:Item))[^\n]*)+"
