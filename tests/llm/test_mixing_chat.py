import hashlib

from pyspark.sql import functions as F

from bidlines.llm.chat import chat_digests, format_chats
from bidlines.llm.mixing import mix, repeat_copies, word_count


def test_mix_edge_cases(spark):
    rows = [(i, " w" * (i % 9), "ab"[i % 2]) for i in range(40)] + [(None, None, None), (7, "x y", None), (7, "x y", None), (50, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("Copies", F.lit(1))
    mixed, c = mix(docs, word_count(F.col("text")))
    got = mixed.collect()
    assert len(got) == len(rows) and all(0 <= r[c["copies"]] <= 2 for r in got)
    for source in ("a", "b", None, "z"):
        own = [r for r in got if r["source"] == source]
        taken = sum(r[c["copies"]] * r[c["size"]] for r in own)
        assert abs(taken - own[0][c["target"]]) <= 8 and own[0][c["target"]] <= 2 * own[0][c["source_size"]]
    assert sorted(map(str, mix(docs.repartition(3), word_count(F.col("text")))[0].collect())) == sorted(map(str, got))
    assert repeat_copies(mixed, c["copies"], docs.columns).count() == sum(r[c["copies"]] for r in got)
    assert mix(docs.limit(0), word_count(F.col("text")))[0].count() == 0


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", r"<\|im_end|> \ <\\s>", None, "", "é🙂" * 30_000, "<<SYS>><</SYS>>"]
    turns = [(1, i, "assistant" if i % 2 else "us\ner\\n", t) for i, t in enumerate(hard * 3)] + [(None, None, None, None), (2, 1, "assistant", "a"), (2, 1, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(9))
    got = {r["conv_id"]: r for r in chat_digests(format_chats(df.repartition(3))).collect()}
    assert got.keys() == {1, 2, None} and [got[k]["n_turns"] for k in (1, 2, None)] == [21, 2, 1]
    said = "".join(t or "" for _, _, r, t in turns[:21] if r == "assistant")
    assert got[1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["loss_chars"] == len(said)
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t or ''}\n" for _, _, r, t in turns[:21]).encode()).hexdigest()
    assert chat_digests(format_chats(df.limit(0))).count() == 0
