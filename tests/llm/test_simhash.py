import re

import numpy as np
import pytest
import xxhash

from bidlines.llm.simhash import DISTANCE, close_fingerprints, fingerprints, keep_one, masks, near_duplicates, tile_labels


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, fps):
    """Smallest id of each component by comparing all pairs."""
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3 and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for i, x in zip(ids, label):
        low[x] = min(low.get(x, i), i)
    return [low[x] for x in label]


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    fps = [fingerprint(r["text"]) for r in rows]
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in near_duplicates(fingerprints(docs)).collect()}
    assert got == {r["doc_id"]: x for r, x in zip(rows, zip(fps, roots([r["doc_id"] for r in rows], fps)))}


def test_edge_texts(spark, docs_of):
    texts = [None, "", "  \n", "one", "one  TWO", "a b c", "A\tb\nc", "é É ß x", "w " * 30000, "x y z x y z x y z", "\x0bq r\x0cs t"]
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in fingerprints(docs_of(list(enumerate(texts)))).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}
    assert got[0] == got[1] == got[2] == 0
    assert near_duplicates(fingerprints(docs_of([]))).count() == 0


def test_masks_leave_no_close_pair_apart():
    rng = np.random.default_rng(1)
    for _ in range(2000):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.integers(0, 64, DISTANCE):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks())


def test_chains_and_dense_groups(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 62, 20)]
    fps = set(base)
    for x in base[:6]:
        y = x
        for _ in range(40):  # a chain: each is close to the one before
            for bit in rng.integers(0, 62, 3):
                y ^= 1 << int(bit)
            fps.add(y)
    fps |= {base[7] ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}
    fps = sorted(fps)
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id bigint, fp bigint").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    assert [got[i] for i in range(len(fps))] == roots(range(len(fps)), fps)


def test_tiles(monkeypatch):
    monkeypatch.setattr("bidlines.llm.simhash.TILE", 3)
    x = np.array([0, 1 << 40 | 1 << 50 | 1 << 60 | 1 << 30, 1, 3, 7, 1 << 40 | 1 << 50, 15, 31], np.uint64)
    assert tile_labels(x, 1).tolist() == [0, 1, 0, 0, 0, 5, 0, 0]


def test_keep_one(spark, docs_of):
    text = "alpha beta gamma delta " * 9
    docs = docs_of([(None, text), (5, text), (3, text), (3, text), (8, "quite other words in here"), (None, "lone words of no id")])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "lone words of no id"), (3, text), (8, "quite other words in here")]
    assert keep_one(docs_of([])).count() == 0
