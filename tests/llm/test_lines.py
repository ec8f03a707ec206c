import random

import pytest

from bidlines.llm import lines as lines_of
from bidlines.llm.lines import dedup_lines, op8_line_dedup


def brute(texts):
    """Removed line numbers by place of the text, texts in order."""
    seen, out = [], []
    for t in texts:
        gone = []
        for i, line in enumerate([] if t is None else t.split("\n")):
            words = {w for w in line.split(" ") if w}
            if words:
                if any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                    gone.append(i)
                seen.append(words)
        out.append(gone)
    return out


def rebuilt(text, gone):
    if text is None or not text.strip(" \n"):
        return text
    lines = [l for i, l in enumerate(text.split("\n")) if i not in gone]
    return "\n".join(lines) if any(l.strip(" ") for l in lines) else "gone"


def test_random_lines_equal_brute_force(spark, docs_of):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [rng.choices(vocabulary, k=rng.randrange(1, 30)) for _ in range(25)]
    texts = []
    for _ in range(120):
        lines = []
        for _ in range(rng.randrange(5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(rng.choice(["", " "]) + "  ".join(line))
        texts.append("\n".join(lines))
    texts += [None, "", "\n\n", "a b c d\na b c d e", "one\n\none", "x " * 20000]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs_of(list(enumerate(texts))).repartition(4)).collect()}
    want = {i: t for i, (t, g) in enumerate(zip(texts, brute(texts))) for t in [rebuilt(t, g)] if t != "gone"}
    assert got == want


def test_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r["removed"] for r in op8_line_dedup(spark, sf).collect()}
    assert got == {r["doc_id"]: ",".join(map(str, g)) for r, g in zip(rows, brute([r["text"] for r in rows]))}


def test_null_keys_repeated_rows_and_empty_table(spark, docs_of):
    docs = docs_of([(None, "a b c\nq r"), (2, "a b c\nx y"), (2, "a b c\nx y"), (1, "x y\nz")]).withColumnRenamed("source", "K").withColumnRenamed("lang", "kept")
    rows = sorted(((r["doc_id"] or 0, r["text"]) for r in dedup_lines(docs).collect()))
    assert rows == [(0, "q r"), (1, "x y\nz"), (2, "a b c"), (2, "a b c")]
    assert dedup_lines(docs).columns == docs.columns
    assert dedup_lines(docs_of([])).count() == 0


@pytest.mark.parametrize("frequent", [0, 3, 512])
def test_large_sets_and_groups_of_like_lines_equal_brute_force(spark, docs_of, monkeypatch, frequent):
    monkeypatch.setattr(lines_of, "FREQUENT", frequent)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.sample(vocabulary, k) for k in (6, 40, 47, 48, 49, 58, 60, 75, 150, 300)]
    texts = []
    for i in range(90):
        line = list(base[0] if i % 3 else rng.choice(base))  # one group is large
        for _ in range(rng.choice([0, 1, 2, 4, len(line) // 9, len(line) // 5])):
            line[rng.randrange(len(line))] = rng.choice(vocabulary)
        texts.append(" ".join(line[: len(line) - rng.randrange(1 + len(line) // 6)]))
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs_of(list(enumerate(texts))).repartition(3)).collect()}
    want = {i: t for i, (t, g) in enumerate(zip(texts, brute(texts))) for t in [rebuilt(t, g)] if t != "gone"}
    assert got == want


def test_rows_of_words_are_not_written_and_large_random_sets_are_no_candidates(spark, docs_of, monkeypatch):
    kept, keep = [], lines_of.cut_lineage
    monkeypatch.setattr(lines_of, "cut_lineage", lambda df: kept.append(keep(df)) or kept[-1])
    pairs, verified = [], lines_of._verified
    monkeypatch.setattr(lines_of, "_verified", lambda rows, places, two, *more: pairs.append(two.count()) or verified(rows, places, two, *more))
    rng = random.Random(10)
    texts = [" ".join(["rare"] + rng.sample([f"w{i}" for i in range(2000)], 199)) for _ in range(200)]
    assert dedup_lines(docs_of(list(enumerate(texts)))).count() == 200
    assert not [k.columns for k in kept if "key" in k.columns]
    assert sum(pairs) < 200


def test_levels_reach_the_driver_as_one_string(spark, docs_of):
    levels = lines_of.token_levels(docs_of([(1, "a a b\nb c"), (2, "a\n"), (3, None)]))
    assert isinstance(levels, str) and levels.count(",") == lines_of.COUNTERS - 1
    assert sorted(levels.split(","))[-3:] == ["4", "4", "6"]
    assert spark.conf.get("spark.sql.codegen.aggregate.fastHashMap.capacityBit", None) in (None, "16")


def test_whole_sets_meet_one_candidate_each_and_the_others_only_where_it_fails(spark, docs_of, monkeypatch):
    met, alike = [], lines_of._alike
    monkeypatch.setattr(lines_of, "_alike", lambda pairs, *more: met.append(pairs.count()) or alike(pairs, *more))
    like = [(i, " ".join(f"w{j}" for j in range(40) if j != i)) for i in range(30)]  # each matches each
    assert [r["doc_id"] for r in dedup_lines(docs_of(like)).collect()] == [0]
    assert met == [29, 0]


def test_a_set_matches_by_any_of_its_candidates(spark, docs_of):
    texts = ["a b c d e", "p q r s t", "a b c d e f", "p q r s u"]
    rows = docs_of(list(enumerate(texts))).selectExpr("doc_id k", "xxhash64(text) h", "text t")
    places = rows.selectExpr("k id", "k", "h", "0 line")
    pairs = spark.createDataFrame([(2, 0), (2, 1), (3, 1), (3, 2)], "id bigint, o bigint")
    assert [r["id"] for r in lines_of._verified(rows, places, pairs, 0.8).collect()] == [2]
