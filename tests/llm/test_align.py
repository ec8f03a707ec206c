import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bidlines.llm import QUERIES, align
from bidlines.llm.tokens import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    return align._Tokenizers(A, B)


def brute(both, texts):
    """The contract by its wording: whole texts, sets of ends, links counted one by one."""
    linked = []
    for text in texts:
        raw = f" {text or ''}".encode()
        a = both.a.encode(f" {text or ''}", add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        if b"".join(both.bytes_a[t] for t in a) != raw or b"".join(both.bytes_b[t] for t in b) != raw:
            linked.append(([], [], []))
            continue
        ends = [list(np.cumsum([len(of[t]) for t in ids])) for of, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        linked.append((a, b, groups))
    count = Counter()
    for _, _, groups in linked:
        count.update({(x, y) for g, h in groups for x in g for y in h})
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for a, b, groups in linked:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return out


TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "  two  blanks ", "don't can't we'll 'tis", "x\n y \nz\t w\r\n q", "naïve café ÀÉ ß 漢字 かな 🙂🙂 ok", "漢" * 40,
    "</s> <s> <unk> <|endoftext|> </s>", "▁ a▁b", "▁", "a b 　 c d", "é ﻿ x", "\x1c \x1d a \x85 b", "= " * 30 + "=" * 200, "0123456789 " * 9,
    "same words same words", "same words same words", "https://x.y/z?q=1&r=%20 #tag @who", "\x00 nul \x00", "ﬁ ligature ½ Ⅷ", "w" * 5000, "ab cd " * 4000,
]


def test_edge_texts_equal_brute_force(spark, both, docs_of, monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 3000)  # several blocks, of which long texts are their own
    docs = docs_of(list(enumerate(TEXTS))).select("doc_id", "text")
    got = {r["doc_id"]: tuple(r[c] for c in FIGURES) for r in align.align_tokens(docs.repartition(3), A, B).collect()}
    assert got == dict(enumerate(brute(both, TEXTS)))
    assert got[0] == got[1] == (0,) * 6 + ("",)
    assert got[13][0] == 0  # the letter that stands for a blank does not come back
    assert got[10][0] > 0


def test_query_equals_brute_force(spark, both, sf_small):
    docs = sf_small(180)
    rows = spark.read.parquet(f"{docs}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r[c] for c in FIGURES) for r in QUERIES["op11_alignment"](spark, docs).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], brute(both, [r["text"] for r in rows])))


def test_other_columns_repeats_and_empty(spark, docs_of):
    docs = docs_of([(1, "a b"), (1, "a b"), (None, None)])
    rows = align.align_tokens(docs, A, B).collect()
    assert sorted(((r["doc_id"] or 0, r["n_a"], r["source"]) for r in rows)) == [(0, 0, "s"), (1, 2, "s"), (1, 2, "s")]
    assert {r["count_sum"] for r in rows} == {0, 4}
    assert align.align_tokens(docs_of([]), A, B).count() == 0
    with pytest.raises(ValueError, match="named as a result"):
        align.align_tokens(docs.withColumnRenamed("lang", "N_A"), A, B)


def test_cuts_on_random_ends():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        inner = [np.sort(rng.choice(np.arange(1, size), int(rng.integers(0, size)), replace=False)) if size > 1 else np.zeros(0, int) for _ in range(2)]
        a, b = (np.r_[x, size] for x in inner)
        groups = align.cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
        assert a[groups[:, 1] - 1].tolist() == b[groups[:, 3] - 1].tolist() == sorted(set(a) & set(b))
        assert groups[1:, [0, 2]].tolist() == groups[:-1, [1, 3]].tolist() and groups[0, [0, 2]].tolist() == [0, 0]


def test_large_groups_by_their_ids(monkeypatch):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 9, 40), rng.integers(0, 7, 50)
    groups = np.array([[0, 3, 0, 2], [3, 33, 2, 42], [33, 40, 42, 50]])

    def all_links():
        total = Counter()
        for g, p, n in zip(*align._group_pairs(a, b, groups)):
            total[int(g), int(p)] += int(n)
        return total

    whole = all_links()
    monkeypatch.setattr(align, "SPREAD", 10)
    assert all_links() == whole and sum(whole.values()) == 6 + 30 * 40 + 7 * 8


def test_bytes_are_compared_by_unit_and_as_a_whole(both):
    """A batch is good at one look; where a unit's bytes don't come back, it alone is left out."""
    plain, odd = [" one", " two three", " é\U0001f600"], " a▁b"
    flat, good = both.encode(plain)
    assert good.all() and both._same_bytes([u.encode() for u in plain], flat[:2], flat[2:])
    assert not both._same_bytes([u.encode() for u in [*plain[1:], plain[0]]], flat[:2], flat[2:])
    more, good = both.encode([plain[0], odd, *plain[1:]])
    assert good.tolist() == [True, False, True, True]
    assert [x.tolist() for x in more[:2]] == [x.tolist() for x in flat[:2]]
