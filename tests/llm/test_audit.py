from itertools import permutations

import pytest

from bidlines.llm import CHECKS, QUERIES, audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """By the wording: every order is played through, document by document."""
    rows = [(i, part or "", text or "") for i, text, part in docs]
    parts = {p: [] for _, p, _ in rows}
    for i, part, text in rows:
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and any(j is not None and j < i and t == text for j, _, t in rows),
        }
        said = [(q, x) for j, q, x in labels if j == i and i is not None]
        parts[part].append((fails, any(q == 1 for q, _ in said), any(x == 1 for _, x in said)))
    out = set()
    for part, found in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = found
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                steps.append([part, "".join(order), step, len(left) - len(gone), len(gone), sum(d[0][f] for d in found) - len(gone),
                              sum(d[0][f] and sum(d[0].values()) == 1 for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone)])
                shapley[f] += len(gone)
                left = [d for d in left if not d[0][f]]
        out |= {(*s, shapley[s[1][s[2] - 1]]) for s in steps}
    return out


def got(df):
    rows = df.select(*COLUMNS).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


LONG = " ".join(f"w{k}" for k in range(120))
DOCS = [
    (1, None, "en"), (2, "", None), (3, "", ""), (4, LONG, "en"), (5, LONG, "en"), (6, LONG, "de"), (7, LONG + " #", "de"), (None, LONG, "en"), (None, LONG, "en"),
    (8, "a " * 200, "en"), (9, "ABC " * 50, "de"), (9, "ABC " * 50, "de"), (9, LONG, "de"), (10, "ABC\x0bx\t\f\r y$", "fr"), (11, "é" * 9 + "A", "fr"), (12, "é" * 8 + "A", "fr"), (13, LONG + " ", "fr"),
]
LABELS = [(4, 1, 0), (5, 1, 1), (5, 1, 1), (5, 0, None), (6, None, 1), (7, 1, None), (9, 1, 1), (99, 1, 1), (None, 1, 1), (13, 1, 0)]


@pytest.fixture
def frames(spark):
    def make(docs=DOCS, labels=LABELS):
        d = spark.createDataFrame([(*r, r[0], "x", "y") for r in docs], "doc_id bigint, text string, lang string, n bigint, mask string, hash string")
        return d.repartition(3), spark.createDataFrame([(*r, "z") for r in labels], "doc_id bigint, quality int, toxic int, n string")

    return make


@pytest.mark.parametrize("limit", [audit.BROADCAST, 0])
def test_edges_equal_brute_force(frames, limit):
    assert got(audit.audit_filters(*frames(), limit=limit)) == brute(DOCS, LABELS)


def test_empty_tables(frames):
    docs, labels = frames()
    assert audit.audit_filters(docs.where("false"), labels).count() == 0
    assert got(audit.audit_filters(docs, labels.where("false"))) == brute(DOCS, [])


def test_sketch_clears_only_unique_hashes(spark, monkeypatch):
    monkeypatch.setattr(audit, "PER_DOCUMENT", 1 << 18)  # several shards
    docs = spark.range(40).selectExpr("xxhash64(id % 37) AS h", "id", "'s' AS shard")
    for limit in (audit.BROADCAST, 0):
        left = audit.possible_repeats(docs, "h", audit.repeat_sketch(docs.select("h"), 40), 40, limit)
        ids = {r["id"] for r in left.collect()}
        assert {0, 1, 2, 37, 38, 39} <= ids and len(ids) < 12 and left.columns == ["h", "id", "shard"]


def test_query_equals_sql(spark, duck):
    sql = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({CHECKS['op12_filter_audit']})").fetchall()
    rows = got(QUERIES["op12_filter_audit"](spark, "/root/testdata/sf0.001"))
    assert rows == set(sql) and len(sql) == len(rows) and len(rows) % 600 == 0
