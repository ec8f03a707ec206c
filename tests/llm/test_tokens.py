from tokenizers import Tokenizer

from bidlines.llm.tokens import count_tokens, vocabulary

TEXTS = [
    None, "", " ", "\n\n  x", "I'll say it's  5 o'clock\t\tnow   ", "<|endoftext|>", "a<|endoftext|>  b !!<|endoftext|>!", "naïve Ünïcode ßtraße 你好 мир ½²３", "tail   nbsp　x \x1c\x85y",
    "🙂🙂 emoji‍zwj", "x" * 5000, "the the the " * 4000, "\x00\x01 control", "<|endoftext", "a" * 3 + "\n" * 7 + "b",
]


def test_counts_equal_the_library(spark, docs_of):
    tokenizer = Tokenizer.from_file(vocabulary())
    pairs = list(enumerate(TEXTS + TEXTS[:5]))
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs_of(pairs).repartition(3), vocabulary()).collect()}
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in pairs}


def test_all_texts_of_the_tables_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(vocabulary())
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, vocabulary()).collect()}
    assert got == {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}


def test_empty_table_and_null_ids(spark, docs_of):
    assert count_tokens(docs_of([]), vocabulary()).count() == 0
    rows = count_tokens(docs_of([(None, "one two"), (None, None)]), vocabulary(), keep=["doc_id"]).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 2] and rows[0]["doc_id"] is None
