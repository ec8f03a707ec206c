import hashlib
import random
import re

from bidlines.llm.secrets import RATIO, op5_secrets, scan_secrets, spans_text, train

BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def base(text):
    found = [(m.start(), i, m.end()) for i, (_, p, g, n) in enumerate(BASE) for m in re.finditer(p, text or "", re.A) if len(m[g]) >= n]
    return [f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


def test_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == want


def test_random_texts(spark, docs_of):
    rng = random.Random(4)
    parts = ["token", "SECRET", "Api_Key", "apikey", "passwd", "=", ":", " ", "  ", '"', "'", "abc", "A1b2C3d4", "-._/+", "AKIA", "ABCDEFGH12345678", "é", "🙂", "\n", "deadbeef" * 3, "0f" * 5, "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", "token=" * 5000, "secret: token: abcdefgh"]
    got = scan_secrets(docs_of(list(enumerate(texts))), [0.0] * 16384).select("doc_id", spans_text("secrets").alias("s")).collect()
    assert all([x for x in r["s"].split(",") if x] == base(texts[r["doc_id"]]) for r in got) and len(got) == len(texts)
    assert scan_secrets(docs_of([]), [0.0] * 16384).count() == 0


def test_models_tell_random_from_ordinary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratios = train(docs)
    score = lambda s: sum(ratios[ord(a) * 128 + ord(b)] for a, b in zip(s, s[1:]))
    rng = random.Random(9)
    keys = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=32)) for _ in range(300)]
    assert sum(score(k) >= RATIO for k in keys) >= 0.97 * len(keys)
    long = [w for r in docs.collect() for w in re.findall(r"[A-Za-z0-9+/_-]{16,}", r["text"]) if w.isalpha()]
    assert sum(score(w) >= RATIO for w in long) <= 0.01 * len(long)


def test_candidate_around_a_base_span(spark, docs_of):
    ratios = train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    key = "qZ7Kp2XvB9sWm4TgR8yL" + "0123456789abcdef01234567" + "XkQ3vZ8LpM5tYw2RbN7G"
    docs = docs_of([(1, f"see {key} here"), (2, f"token={key}")]).withColumnsRenamed({"lang": "own", "source": "_base"})
    got = scan_secrets(docs, ratios)
    assert got.columns == [*docs.columns, "secrets"]
    spans = {r["doc_id"]: r["s"] for r in got.select("doc_id", spans_text("secrets").alias("s")).collect()}
    assert spans == {1: "random:4:68,hex:24:48", 2: "assign:0:70,hex:26:50"}
