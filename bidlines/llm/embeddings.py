"""Embedding near-duplicates by randomly rotated binary codes with stored correction factors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut_lineage, query, table

COSINE = 0.9
#: Share of the pairs just at the threshold that may share no key of any table; at 0.95 hardly any does.
MISS = 0.04
#: Factor of the confidence bound, and vectors compared at once.
EPSILON, TILE = 4.0, 1024
#: A group of more rows than PART is dealt out as pairs of parts; one of SMALL rows at most is compared with many others at once.
PART, SMALL = 2048, 16
SEED = 11


def index_size(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Tables and bits of a key for n vectors: groups of unlike vectors stay at a few, and enough tables that few pairs are missed."""
    bits = max(6, int(np.ceil(np.log2(max(n, 2)))) - 2)
    meet = (1 - np.arccos(cosine) / np.pi) ** bits
    return int(np.ceil(np.log(miss) / np.log(1 - meet))), bits


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def table_keys(unit: np.ndarray, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Keys (rows x tables): the signs of each vector on random directions."""
    planes = np.random.default_rng(seed).normal(size=(unit.shape[1], tables * bits))
    signs = (unit @ planes >= 0).reshape(len(unit), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(2).astype(np.int32)


def codes(unit: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes of the rotated vectors, and the factor: inner product of each vector with its own code."""
    turned = unit @ rotate
    sign = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(unit.shape[1])
    return sign.astype(np.float32), (turned * sign).sum(1)


def estimate(code: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the inner products of coded vectors with whole rotated ones, and their half widths."""
    dim = code.shape[1]
    half = EPSILON * np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * max(dim - 1, 1)))
    return (code @ turned.T.astype(np.float32)) / factor[:, None].astype(np.float32), half


def _unit(vectors: list, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable rows, and which rows these are."""
    out, good = np.zeros((len(vectors), dim)), np.zeros(len(vectors), bool)
    for i, v in enumerate(vectors):
        if v is not None and len(v) == dim:
            x = np.array([np.nan if c is None else c for c in v], np.float64)
            if np.isfinite(x).all():
                x = x / (np.abs(x).max() or 1.0)  # squares of very large or small components stay finite
                norm = np.sqrt((x * x).sum())
                if norm > 0:
                    out[i], good[i] = x / norm, True
    return out[good], np.flatnonzero(good)


def _index(tables, bits, seed):
    def run(batches):
        """(row, vector) to one row for each table: key, the keys of all tables, code, factor and unit vector."""
        rotations: dict = {}
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            for dim in sorted({len(v) for v in vectors if v}):
                unit, at = _unit(vectors, dim)
                if not len(unit):
                    continue
                key = table_keys(unit, tables, bits, seed)
                rotate = rotations.setdefault(dim, rotation(dim, seed + 1))
                code, factor = codes(unit, rotate)
                packed = np.packbits(code > 0, axis=1)
                lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.full(len(unit), dim, np.int32)), lists(key), pa.array([c.tobytes() for c in packed], pa.binary()), pa.array(factor), lists(unit)],
                    names=["row", "dim", "keys", "code", "factor", "unit"],
                )

    return run


def _follow(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Lets the smaller label run along the links until none changes."""
    while True:
        low = np.minimum(label[x], label[y])
        if (label[x] == low).all() and (label[y] == low).all():
            return
        np.minimum.at(label, x, low), np.minimum.at(label, y, low)


class _Rows:
    """Rows of whole groups as arrays; all have vectors of one length."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        n = batch.num_rows
        of = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        matrix = lambda name: batch.column(name).flatten().to_numpy().reshape(n, -1)
        self.row, self.table, self.side, self.factor, self.copies = (of(c) for c in ("row", "table", "side", "factor", "copies"))
        self.keys, self.unit = matrix("keys"), matrix("unit")
        dim = self.unit.shape[1]
        bits = np.unpackbits(np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, -1), axis=1)[:, :dim]
        self.code = ((2.0 * bits - 1) / np.sqrt(dim)).astype(np.float32)
        self.turned = (self.unit @ rotation(dim, seed + 1)).astype(np.float32)
        self.half = EPSILON * np.sqrt(np.maximum(1 - self.factor**2, 0) / (self.factor**2 * max(dim - 1, 1)))
        self.label, self.degree = np.arange(n), np.zeros(n, np.int64)

    def link(self, x: np.ndarray, y: np.ndarray, cosine: float, count: bool = True) -> None:
        """Link those of the candidate pairs that reach the threshold when computed exactly."""
        for k in range(0, len(x), 1 << 15):
            a, b = x[k : k + (1 << 15)], y[k : k + (1 << 15)]
            near = np.einsum("ij,ij->i", self.unit[a], self.unit[b]) >= cosine
            a, b = a[near], b[near]
            if count:  # each pair counts in the first table whose group holds both
                same = (self.keys[a] == self.keys[b]).argmax(1) == self.table[a]
                np.add.at(self.degree, a[same], self.copies[b[same]])
                np.add.at(self.degree, b[same], self.copies[a[same]])
            _follow(self.label, a, b)

    def small(self, group: np.ndarray, largest: int, cosine: float) -> None:
        """All pairs within groups of few rows, by distance in the order."""
        found = []
        for d in range(1, largest):
            x = np.flatnonzero(group[d:] == group[:-d])
            y = x + d
            if len(x):
                guess = np.einsum("ij,ij->i", self.code[x], self.turned[y]) / self.factor[x]
                may = guess + self.half[x] >= cosine
                found.append((x[may], y[may]))
        if found:
            x, y = (np.concatenate(c) for c in zip(*found))
            self.link(x, y, cosine)
            self.settle([(x, y)], cosine)

    def settle(self, pairs, cosine: float) -> None:
        before = None
        while before is None or (before != self.label).any():
            before = self.label.copy()
            for x, y in pairs:
                self.link(x, y, cosine, count=False)

    def large(self, cosine: float) -> None:
        """All pairs of one group or of two parts of one, a tile at a time."""
        whole = (self.side == 2).all()
        one, two = (np.arange(len(self.row)),) * 2 if whole else (np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1))
        first = True
        while True:
            before = self.label.copy()
            for i in range(0, len(one), TILE):
                for j in range(0, i + 1 if whole else len(two), TILE):
                    p, q = one[i : i + TILE], two[j : j + TILE]
                    guess = (self.code[p] @ self.turned[q].T) / self.factor[p, None]
                    a, b = np.nonzero(guess + self.half[p, None] >= cosine)
                    if whole and i == j:
                        a, b = a[a > b], b[a > b]
                    self.link(p[a], q[b], cosine, count=first)
            first = False
            if (before == self.label).all():
                return

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = (self.label != np.arange(len(self.row))) | (self.degree > 0)
        return self.row[keep], self.row[self.label[keep]], self.degree[keep]


GROUP = ("dim", "table", "key", "part")


def _links(cosine, seed):
    def work(batch: pa.RecordBatch):
        """Whole groups, in order, to (row, root, n)."""
        at = [batch.column(c).to_numpy() for c in GROUP]
        new = np.r_[True, np.any([a[1:] != a[:-1] for a in at], axis=0)]
        bounds = np.r_[np.flatnonzero(new), batch.num_rows]
        sizes = np.diff(bounds)
        large = np.repeat((sizes > SMALL) | (batch.column("side").to_numpy()[bounds[:-1]] != 2), sizes)
        out = []
        for dim in np.unique(at[0][~large]):
            rows = np.flatnonzero(~large & (at[0] == dim))
            r = _Rows(batch.take(pa.array(rows)), seed)
            r.small(np.cumsum(new)[rows], int(sizes[sizes <= SMALL].max()), cosine)
            out.append(r.result())
        for k in np.flatnonzero((sizes > 1) & large[bounds[:-1]]):
            r = _Rows(batch.slice(bounds[k], sizes[k]), seed)
            r.large(cosine)
            out.append(r.result())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["row", "root", "n"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held:
                batch = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            last = np.ones(batch.num_rows, bool)
            for c in GROUP:
                col = batch.column(c).to_numpy()
                last &= col == col[-1]
            start = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last group may go on in the next batch
            if start:
                yield from work(batch.slice(0, start))
            held = [batch.slice(start)]
        if held:
            yield from work(held[0])

    return run


def link_vectors(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """(row, root, n) of the links found between distinct vectors (row, vector, copies).

    Every vector lies in one group of each table, by the signs of random directions. Within a
    group, the binary code of one vector and the whole other vector give an unbiased estimate of
    their cosine; pairs whose upper bound reaches the threshold are computed again in double
    precision and linked if they reach it. ``n`` adds up the copies of the vectors linked, each
    pair counted in the first table that has it; ``root`` connects, through others or not, to a
    vector of the same group. Groups are worked on in tiles; a group of more than PART rows is
    dealt out as pairs of parts, so no task gathers it.
    """
    tables, bits = index_size(vectors.count(), cosine, miss)
    indexed = cut_lineage(vectors.select("row", "vector").mapInArrow(_index(tables, bits, seed), "row bigint, dim int, keys array<int>, code binary, factor double, unit array<double>").join(vectors.select("row", "copies"), "row"))
    spread = indexed.select("row", "dim", F.posexplode("keys").alias("table", "key"))
    sizes = spread.groupBy("table", "key", "dim").agg(F.count("*").alias("size")).where("size > 1")
    parts = cut_lineage(sizes.withColumn("parts", F.ceil(F.col("size") / PART).cast("int")))
    met = spread.join(parts, ["table", "key", "dim"])
    own = F.pmod(F.xxhash64("row", "table"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = met.withColumn("own", own).withColumn("other", F.explode(other))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    dealt = dealt.select("table", "key", "dim", "row", pair.alias("part"), side.alias("side"))
    full = dealt.join(indexed.drop("dim"), "row")
    grouped = full.repartition("dim", "table", "key", "part").sortWithinPartitions("dim", "table", "key", "part", "row")
    return grouped.mapInArrow(_links(cosine, seed), "row bigint, root bigint, n bigint")


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Rows of equal components are collapsed to one vector with a number of copies and link with one
    another. Null and zero vectors and those with null or non-finite components link with nothing;
    vectors of different lengths do not link. Repeated rows are copies of one another; null keys
    take part, but are the smallest of a component only if it has no other. An empty table gives
    an empty one.
    """
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + 0.0))  # -0 is 0
    fit = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = cut_lineage(rows.withColumn("fit", F.coalesce(fit, F.lit(False))))
    good = rows.where("fit")
    distinct = good.groupBy("v").agg(F.count("*").alias("copies"), F.min("k").alias("low")).withColumn("row", F.monotonically_increasing_id())
    distinct = cut_lineage(distinct)
    links = cut_lineage(link_vectors(distinct.select("row", F.col("v").alias("vector"), "copies"), cosine))
    degree = links.groupBy("row").agg(F.sum("n").alias("n"))
    roots = cut_lineage(components(links.select(F.col("row").alias("a"), F.col("root").alias("b"))))
    placed = distinct.join(degree, "row", "left").join(roots.withColumnRenamed("node", "row"), "row", "left")
    placed = placed.select("v", "copies", "low", F.coalesce("root", "row").alias("root"), F.coalesce("n", F.lit(0)).alias("n"))
    low = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    whole = placed.join(low, "root").select("v", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.join(whole, "v").select("k", "n_links", "component_id")
    alone = rows.where("not fit").select("k", F.lit(0).cast("bigint").alias("n_links"), F.col("k").alias("component_id"))
    return linked.unionByName(alone).select(F.col("k").alias(key), "n_links", "component_id", F.coalesce(F.col("k") == F.col("component_id"), F.lit(False)).alias("kept"))


@query()
def op9_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
