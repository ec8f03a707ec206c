import numpy as np

from bidlines.llm.embeddings import codes, estimate, near_vectors, rotation


def brute(ids, vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label, np.where(near, label[None], len(ids)).min(1))
        if (low == label).all():
            break
        label = low
    low = {}
    for i, l in zip(ids, label):
        low[l] = min(low.get(l, i), i)
    return {i: (int(n), low[l], low[l] == i) for i, n, l in zip(ids, near.sum(1), label)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


def collected(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def clusters(rng, groups, dim=64, spread=0.15):
    out = []
    for n in groups:
        centre = rng.normal(size=dim)
        out += [(centre + spread * rng.normal(size=dim)).astype(np.float32).tolist() for _ in range(n)]
    return out


def test_clusters_and_copies_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("bidlines.llm.embeddings.PART", 40)
    rng = np.random.default_rng(5)
    vectors = clusters(rng, [1] * 60 + [5] * 10 + [150])
    vectors += vectors[:20] * 3
    ids = rng.permutation(len(vectors)).tolist()
    got, true = collected(near_vectors(frame(spark, [(i, v, 0) for i, v in zip(ids, vectors)]))), brute(ids, vectors)
    assert {i: g[1:] for i, g in got.items()} == {i: t[1:] for i, t in true.items()}
    assert all(g[0] <= true[i][0] for i, g in got.items())
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(t[0] for t in true.values())


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(400):  # pairs with a cosine from 0.9 to 0.93
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.9, 0.93)
        vectors += [a.tolist(), (c * a + (1 - c * c) ** 0.5 * b).tolist()]
    got = collected(near_vectors(frame(spark, [(i, v, 0) for i, v in enumerate(vectors)])))
    true = brute(list(range(len(vectors))), np.array(vectors, np.float32))
    assert all(got[i][0] <= true[i][0] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(t[0] for t in true.values())


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rotate = rotation(64, 12)
    guess, half = estimate(*codes(x, rotate), x @ rotate)
    wrong = guess - x @ x.T
    assert abs(wrong.mean()) < 0.01 and (np.abs(wrong) <= half[:, None] + 1e-6).mean() > 0.999


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (9, [1.0, 0.0], 0), (8, [3e30, -0.0], 0), (7, [1e-30, 1e-32], 1), (10, [1.0], 0), (None, [0.0, 1.0], 0), (9, [1.0, 0.0], 2)]
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(frame(spark, rows)).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)]
    assert got == sorted([*alone, (7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (9, 3, 7, False), (0, 0, None, False)], key=repr)
    assert near_vectors(frame(spark, [])).count() == 0
