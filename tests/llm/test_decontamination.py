import random
import re

from bidlines.llm.common import CHECKS
from bidlines.llm.decontamination import decontaminate, drop_contaminated, op6_decontamination, proximity_matches


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for i, t in items:
        b = words(t)
        n = min(13, len(b))
        for s in range(len(b) - n + 1 if b else 0):
            for d in range(len(w) - n + 1):
                if w[d : d + n] == b[s : s + n]:
                    hit |= set(range(d, d + n))
                    found.add(str(i))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def check(spark, docs_of, texts, items):
    got = decontaminate(docs_of(list(enumerate(texts))).repartition(3), items_of(spark, items)).collect()
    assert {r["k"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got} == {i: brute(t, items) for i, t in enumerate(texts)}


def test_random_texts_equal_brute_force(spark, docs_of):
    rng = random.Random(3)
    vocabulary = ["A", "b", "É", "é", "z9", "ß", "Q"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([30, 14, 13, 12, 5, 2, 1, 0, 20])] + [(20, None), (21, "..."), (10, "rare one here")]
    texts = [say(rng.randrange(0, 40)) for _ in range(30)]
    for _ in range(30):
        part = words(rng.choice(items)[1])
        a = rng.randrange(0, len(part) + 1)
        texts.append(say(rng.randrange(6)) + ", " + "--".join(part[a : a + rng.randrange(1, 25)]).upper() + " " + say(rng.randrange(300)))
    check(spark, docs_of, [*texts, None, "", "!!", items[0][1] * 3], items)


def test_empty_tables_nulls_and_repeated_rows(spark, docs_of):
    items = [(1, "one two three")]
    docs = docs_of([(None, "One two three"), (None, "one"), (7, "one two THREE"), (7, "one two THREE")])
    rows = decontaminate(docs, items_of(spark, items)).collect()
    assert sorted((r["k"] or 0, r["n_hit"]) for r in rows) == [(0, 0), (0, 3), (7, 3), (7, 3)]
    assert [r["text"] for r in drop_contaminated(docs.withColumnRenamed("lang", "H"), items_of(spark, items)).collect()] == ["one"]
    assert decontaminate(docs_of([]), items_of(spark, items)).count() == 0
    assert {r["n_hit"] for r in decontaminate(docs, items_of(spark, [])).collect()} == {0}


def test_proximity(spark, docs_of):
    docs = docs_of([(1, "red the apple fell"), (2, "apple red"), (3, "red one two three four five apple"), (4, None)])
    got = proximity_matches(docs, items_of(spark, [(5, "red apple"), (6, None)]), 2).collect()
    assert [(r["k"], r["item_id"], r["first"], r["last"]) for r in got] == [(1, 5, 0, 2)]


def test_repeated_item_rows_texts_under_one_id_and_null_ids(spark, docs_of):
    say = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    texts = ["x " + say("a", 13) + " y", say("b", 13), say("c", 13) + " y", say("d", 3), say("e", 14), say("f", 13) + " " + say("b", 13), "nothing"]
    items = [(1, say("a", 13)), (1, say("a", 13)), (2, say("b", 13)), (2, say("c", 13)), (2, say("d", 3)), (3, say("b", 13)), (None, say("e", 14)), (None, say("e", 14)), (None, say("f", 13))]
    got = decontaminate(docs_of(list(enumerate(texts))), items_of(spark, items).repartition(4)).collect()
    assert {r["k"]: (r["n_hit"], r["item_ids"]) for r in got} == {0: (13, ["1"]), 1: (13, ["2", "3"]), 2: (13, ["2"]), 3: (3, ["2"]), 4: (14, [None]), 5: (26, ["2", "3", None]), 6: (0, [])}
    assert [r["text"] for r in drop_contaminated(docs_of(list(enumerate(texts))), items_of(spark, items)).collect()] == ["nothing"]


def test_query_with_such_items_equals_its_sql(spark, docs_of, duck, tmp_path):
    items = [(1, "one two three"), (1, "one two three"), (1, "four five six"), (None, "seven eight"), (None, "seven eight")]
    docs_of([(1, "One two three"), (2, "four five six, seven eight"), (3, "seven eight"), (4, "nine")]).write.parquet(f"{tmp_path}/documents.parquet")
    items_of(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duck.cursor()
    con.execute("CREATE SCHEMA own")
    con.execute("USE own")
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(CHECKS["op6_decontamination"]).fetchall())
    con.execute("DROP SCHEMA own CASCADE")
    assert sorted(map(tuple, op6_decontamination(spark, str(tmp_path)).collect())) == want


def test_proximity_of_repeated_item_rows_and_null_ids(spark, docs_of):
    items = [(5, "red apple"), (5, "red apple"), (5, "blue pear"), (None, "green plum")]
    got = proximity_matches(docs_of([(1, "red apple"), (2, "blue pear"), (3, "green plum")]), items_of(spark, items), 0).collect()
    assert sorted((r["k"], r["item_id"]) for r in got) == [(1, 5), (2, 5), (3, None)]
