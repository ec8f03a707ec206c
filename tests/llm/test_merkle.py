import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bidlines.llm import QUERIES, merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def parts(text):
    """Paragraphs of the sections of a text."""
    cut = lambda p, t: [x for x in re.split(p, t) if x]
    section = merkle.SECTION.replace(r"(?<=\n[ \t]{0,9}\n)(?=\S)", "|".join(rf"(?<=\n[ \t]{{{k}}}\n)(?=\S)" for k in range(10)))
    return [cut(merkle.PARAGRAPH, s) for s in cut(section, text)]


def root(text):
    return sha("".join(sha("".join(map(sha, s))) for s in parts(text)))


def likeness(a, b):
    """Sections both have count whole; of the others, the different paragraphs."""
    if a == b:
        return 1.0
    x, y = parts(a), parts(b)
    both = {tuple(s) for s in x} & {tuple(s) for s in y}
    shared = sum(len("".join(s)) for s in x + y if tuple(s) in both)
    p, q = ({t for s in side if tuple(s) not in both for t in s} for side in (x, y))
    shared += 2 * sum(map(len, p & q))
    return shared / (shared + sum(map(len, p ^ q)) + 1)


def edit(a, b):
    x, y = parts(a), parts(b)
    if x == y:
        return None
    x, y = (["".join(s) for s in side] for side in (x, y))
    start = end = 0
    xs, ys = parts(a), parts(b)
    while xs and ys and xs[0] == ys[0]:
        start += len("".join(ys[0]))
        xs, ys = xs[1:], ys[1:]
    while xs and ys and xs[-1] == ys[-1]:
        end += len("".join(ys[-1]))
        xs, ys = xs[:-1], ys[:-1]
    xs, ys = ([p for s in side for p in s] for side in (xs, ys))
    while xs and ys and xs[0] == ys[0]:
        start += len(ys[0])
        xs, ys = xs[1:], ys[1:]
    while xs and ys and xs[-1] == ys[-1]:
        end += len(ys[-1])
        xs, ys = xs[:-1], ys[:-1]
    return start, len(b) - end


def expected(docs, order):
    """Rows of the contract, the documents being in order of their keys."""
    out = Counter()
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        span = edit(text, changed) or (None, None)
        out[i, len(text), sha(changed), root(text), root(changed), round(likeness(text, changed), 9), round(likeness(text, after), 9), *span] += 1
    return out


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edit_start", "edit_end")


def got(df):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*COLUMNS).collect())


TEXTS = [
    "", None, "a", "\n", "one line. Two, said him. A third was all. And so on", "é漢🙂 bed。漢漢 bed bad.\n\n# head\nbad bed\n \t\n\nrest", "x" * 70000,
    "said him. " * 3000, "said him. " * 2999 + "said her. ", "said him. " * 3000, "  lead\n\n\n\ntail  \n",
]


@pytest.fixture
def run(spark, tmp_path):
    def make(pairs, rows=None, monkeypatch=None):
        path = tmp_path / "documents.parquet"
        df = spark.createDataFrame([(i, t, i, "x", "y") for i, t in pairs], "doc_id bigint, text string, tree bigint, span string, bounds string")
        df.repartition(3).write.mode("overwrite").parquet(str(path))
        return QUERIES["op13_fingerprints"](spark, str(tmp_path))

    return make


@pytest.mark.parametrize("rows", [1, 3, 1024])
def test_edges_equal_brute_force(spark, run, monkeypatch, rows):
    monkeypatch.setattr(merkle.with_next_text, "__defaults__", ("doc_id", "text", rows, 1 << 18))
    docs = [(7 * k - 20, t) for k, t in enumerate(TEXTS)]
    assert got(run(docs)) == expected(docs, docs[::-1])


def test_null_and_repeated_keys(spark, run):
    assert got(run([(None, "said him"), (2, "b a"), (1, None)])) == expected(None, [(2, "b a"), (1, None), (None, "said him")])
    twins = [(5, "bed him all"), (5, "bed him all"), (4, "end")]
    assert got(run(twins)) == expected(None, twins)
    assert got(run([(3, "bed him all")])) == expected(None, [(3, "bed him all")])
    assert run([]).count() == 0
    two = {t: spark.sql("SELECT xxhash64(:t) AS h", {"t": t}).first()["h"] for t in ("first one", "second one", "third")}
    order = [(9, t) for t in sorted(two, key=two.get)] + [(1, "z")]
    assert got(run(order[::-1])) == expected(None, order)


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3), (2, None, 4, 5, 6)], "doc_id int, text string, `order` int, guest int, next_tree int")
    met, names = merkle.with_next_text(docs)
    assert met.columns == [*docs.columns, *names.values()] and names["next_tree"] == "_next_tree"
    assert {tuple(r) for r in met.select(*docs.columns, names["next_text"]).collect()} == {(1, "a b", 1, 2, 3, ""), (2, None, 4, 5, 6, "a b")}
    with pytest.raises(ValueError, match="has a column"):
        merkle.fingerprints(docs, name="GUEST")
    assert merkle.fingerprints(docs).where(F.col("tree.root").isNull()).isEmpty()


def test_edit_is_found(spark):
    text = " ".join(f"word{k} bed. him{k} was all{k}." for k in range(400))
    changed = text.replace("him200", "her")
    span = merkle.edit_span(merkle.merkle_tree(F.lit(text)), merkle.merkle_tree(F.lit(changed)))
    start, end = spark.range(1).select(span.alias("s")).select("s.*").first()
    assert start <= changed.index("her") < changed.index("her") + 3 <= end < start + 90


def test_query_equals_brute_force(spark, sf_small):
    docs = sf_small(200)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{docs}/documents.parquet").collect()]
    found = got(QUERIES["op13_fingerprints"](spark, docs))
    assert found == expected(rows, sorted(rows, reverse=True))
    near = [r[5] for r in found if r[1] > 500]
    assert 0.35 < sum(near) / len(near) < 0.65
