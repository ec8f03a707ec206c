import random
from itertools import combinations

import numpy as np
import pytest

from bidlines.llm import toxicity
from bidlines.llm.toxicity import DECAY, LENGTH, RUN, SKIP, WORDLESS, kernel, labelled, op10_toxicity, score, spans_tops, subsequences, train


def features(span):
    """Weights of the subsequences of a span by enumeration, scaled by the squared weights of all places."""
    letters, out, size = f" {span} ", {}, 0.0
    for places in combinations(range(len(letters)), LENGTH):
        gap = places[-1] - places[0] + 1 - LENGTH
        if gap <= SKIP:
            key = "".join(letters[p] for p in places)
            out[key] = out.get(key, 0) + DECAY**gap
            size += DECAY ** (2 * gap)
    return {k: v / max(size, 1.0) ** 0.5 for k, v in out.items()}


def slow_kernel(a, b):
    a, b = features(a), features(b)
    return sum(v * b.get(u, 0) for u, v in a.items())


def test_kernel_equals_enumeration():
    spans = ["stupid", "stxupid", "stu pid", "idiot", "banana", "a", "ab", "you are an idiot", "the table"]
    got = kernel(spans, spans)
    assert np.allclose(got, [[slow_kernel(a, b) for b in spans] for a in spans])
    assert min(got[0, 1], got[0, 2]) > 0.3 > got[0, 4]


def own_model():
    """Weights at random, so that a wrong letter, place or scale shows."""
    weights = np.random.default_rng(7).normal(size=toxicity.CLASSES**LENGTH).astype(np.float32)
    return {"weights": weights, "constant": 0.25, "a": 1.0, "b": 0.0}


def slow_top(sentences, model):
    def span_score(span):
        row, code, w = subsequences([span])
        return float((w * model["weights"][code]).sum()) + model["constant"]

    spans = [" ".join(words[i : i + n]) for words in sentences for n in range(1, RUN + 1) for i in range(len(words) - n + 1)]
    return max(map(span_score, spans), default=WORDLESS)


def test_most_toxic_span_equals_all_spans():
    model = own_model()
    texts = {
        "You are here. Not (there)!\nAnd so on": [["you", "are", "here"], ["not", "there"], ["and", "so", "on"]],
        "  one  ": [["one"]],
        "i d i o t": [["idiot"]],
        "": [],
        " . !? ": [],
        "a b": [["a", "b"]],
        "Grüße und 1d10t, $tupid": [["grüße", "und", "1d10t", "$tupid"]],
    }
    assert np.allclose(spans_tops(list(texts), model), [slow_top(s, model) for s in texts.values()], atol=1e-4)


def test_long_text_in_pieces(monkeypatch):
    model, rng = own_model(), random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    whole = spans_tops([text, "ab cd", text[:500]], model)
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 700)
    assert np.allclose(spans_tops([text, "ab cd", text[:500]], model), whole, atol=1e-4)
    assert len(spans_tops(["x" * 5000], model)) == 1


PROBES = ["an idiot", "an i d i o t", "you are an idixot", "an id iot", "an idi ot", "hello there of the", "a tahble", ""]


@pytest.fixture(scope="module")
def fitted(spark):
    return train(labelled(spark, "/root/testdata/sf0.01"))


def probe_scores(spark, model):
    return [r["score"] for r in score(spark.createDataFrame([(p,) for p in PROBES], "text string").coalesce(1), model).collect()]


def test_held_out_texts(spark, fitted):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["score"] for r in score(docs, fitted, keep=["doc_id"]).collect()}
    assert len(rows) == docs.count() and all(0 <= s <= 1 for s in rows.values())
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    assert sum((rows[r["doc_id"]] >= 0.5) == r["toxic"] for r in labels) >= 0.93 * len(labels)
    scores = probe_scores(spark, fitted)
    assert min(scores[:2]) >= 0.5 > max(scores[5:])
    assert min(scores[2:5]) > max(scores[5:])


@pytest.mark.xfail(strict=False, reason="open: disguised forms score between plain insults and ordinary words, some of them under a half")
def test_disguised_forms_are_predicted(spark, fitted):
    assert min(probe_scores(spark, fitted)[2:5]) >= 0.5


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in op10_toxicity(spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    held = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()}
    assert held == {k for k, r in rows.items() if r["held_out"]}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in held]
    assert sum(rows[r["doc_id"]]["predicted"] == r["toxic"] for r in labels) >= 0.95 * len(labels)


def test_phrase_of_usual_words(spark):
    rng, phrase = random.Random(1), "i will find you tonight"
    usual = f"{phrase} the house was green and we went home after dinner to see my friends at market".split()
    rows = []
    for k in range(800):
        words = [rng.choice(usual) for _ in range(30)]
        words[7:7] = phrase.split() if k % 4 == 0 else []
        rows.append((" ".join(words), int(k % 4 == 0)))
    model = train(spark.createDataFrame(rows[:600], "text string, toxic int"))
    top = spans_tops([t for t, _ in rows[600:]], model)
    assert np.mean((model["a"] * top + model["b"] >= 0) == [y for _, y in rows[600:]]) >= 0.97


def test_edge_cases(spark, docs_of):
    rows = [("awful scum here", 1), ("awful scum there", 1), ("fine day", 0), (None, 0), ("", 0), ("x", None)] * 3
    texts = spark.createDataFrame(rows, "text string, toxic int")
    model = train(texts)
    docs = docs_of([(1, None), (1, None), (None, ""), (2, "word " * 50_000)]).withColumnRenamed("lang", "SCORE_")
    assert score(docs, model).count() == 4
    assert score(docs_of([]), model).count() == 0
    own = docs.withColumn("Score", docs["doc_id"]).withColumn("_score", docs["text"])
    assert score(own, own_model()).columns == ["__score", *own.columns]
    assert train(texts.where("toxic = 0"))["constant"] == 0.0
    assert {r["score"] for r in score(docs, {"constant": 0.0}).collect()} == {0.0}
