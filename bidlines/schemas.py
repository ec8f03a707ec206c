"""Column types of the tables that go in and out."""

# The fields of a notice file that are read; others may hold anything. The header fields stay
# VARIANT so that an absent field, a JSON null and a value of another type can be told apart.
NOTICE_SCHEMA = """
data struct<numero_pregao variant, orgao variant, itens array<string>, cidade variant, estado variant, anexos variant>
"""

# Only the parts of an attachment reference that are used or passed through.
ATTACHMENT_REF = (
    "array<struct<nome:variant,formato:string,url:string,caminho:string,hash_content:string,caminho_json:string>>"
)

ITEM = "struct<lote:string,item:bigint,objeto:string,quantidade:bigint,unidade_fornecimento:string>"
ITEM_FIELDS = ("lote", "item", "objeto", "quantidade", "unidade_fornecimento")
NOTICE_FIELDS = ("arquivo_json", "numero_pregao", "orgao", "cidade", "estado")

PROCESSED_NOTICE = f"""
arquivo_json string, numero_pregao string, orgao string, cidade string, estado string,
anexos_processados array<string>, itens_extraidos array<{ITEM}>
"""
FAILURE = "ts timestamp, arquivo_json string, anexo string, motivo string"
ITEM_ROWS = """
arquivo_json string, tier int, att_pos int, block_pos bigint, lote string, item bigint, objeto string,
quantidade bigint, unidade_fornecimento string
"""
ANSWERS = "arquivo_json string, att_pos int, raw string"
PAGES = "arquivo_json string, att_pos int, page_no int, text string"
FILES = "folder string, file_name string, path string, length bigint"
