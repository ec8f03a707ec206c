"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut_lineage, fresh, query, table
from .xxh64 import xxh64

WORDS, DISTANCE = 3, 3
#: Bits of the blocks; fingerprints that differ in 3 bits at most agree on 3 of 6 blocks at least.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Fingerprints compared at once; bytes of text worked on at once (a longer text is worked on alone).
TILE, CHUNK = 2048, 1 << 20


def masks(blocks=BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One 64-bit mask for each choice of blocks that a close pair may agree on."""
    starts = np.cumsum([0, *blocks])
    own = [((1 << b) - 1) << int(s) for b, s in zip(blocks, starts)]
    return [sum(c) for c in combinations(own, len(blocks) - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _shingles(offsets: np.ndarray, data: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the lower-cased shingles of texts that lie behind one another, each with its text's number, in order."""
    # A text may not run into the next: each gets a blank behind it.
    at = np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = np.full(len(data) + len(offsets) + 16, 32, np.uint8)
    wide[at] = _LOWER[data]
    word = ~_SPACE[wide]
    keep = word.copy()
    keep[1:] |= word[:-1]  # one blank behind each word
    plain = wide[keep]
    plain[~word[keep]] = 32
    ends = np.flatnonzero(plain == 32)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    text_ends = np.cumsum(keep)[offsets[1:] + np.arange(len(offsets) - 1)] if len(offsets) > 1 else np.zeros(0, np.int64)
    owner = np.searchsorted(text_ends, starts, side="right")
    count = np.bincount(owner, minlength=len(offsets) - 1)[: len(offsets) - 1]
    first = np.cumsum(count) - count
    place = np.arange(len(starts)) - first[owner] if len(starts) else starts
    head = np.flatnonzero(place <= np.maximum(count[owner] - words, 0)) if len(starts) else starts
    last = np.minimum(head + words - 1, (first + count - 1)[owner[head]]) if len(starts) else starts
    plain = np.r_[plain, np.zeros(16, np.uint8)]
    return xxh64(plain, starts[head], ends[last] - starts[head]), owner[head]


def _fingerprints(words):
    def run(batches):
        """(text, ...) to (fingerprint, ...): a bit is set if it is in over half of the hashes."""
        for batch in batches:
            text = pa.concat_arrays([batch.column(0).cast(pa.large_binary())])
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            out = np.zeros(len(text), np.uint64)
            row = 0
            while row < len(text):
                end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
                hashes, owner = _shingles(offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]], words)
                full, first, count = np.unique(owner, return_index=True, return_counts=True)
                if len(full):
                    sums = np.zeros((len(full), 64), np.int64)
                    if len(full) == 1:  # a text of any length goes through in slices
                        for k in range(0, len(hashes), CHUNK):
                            sums[0] += np.unpackbits(hashes[k : k + CHUNK].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
                    else:
                        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
                        sums = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
                    out[row + full] = np.packbits(2 * sums > count[:, None], axis=1).view(np.uint64).ravel()
                row = end
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64)), *batch.columns[1:]], names=["_fp", *batch.schema.names[1:]])

    return run


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", keep: list[str] | None = None, words: int = WORDS) -> DataFrame:
    """Columns ``keep`` (all but the text, by default) with the 64-bit fingerprint of the whole text; narrow.

    Shingles are the byte ranges of ``words`` words in a row of the text with its white space made
    single blanks and A-Z lower-cased, and are hashed and counted by column. A shorter text is one
    shingle; null, empty and blank texts have fingerprint 0.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    raw = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_fp"), *keep)
    types = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    kept = "".join(f", `{c}` {types[c]}" for c in keep)
    return raw.mapInArrow(_fingerprints(words), f"_fp bigint{kept}").withColumnRenamed("_fp", name)


def tile_labels(x: np.ndarray, distance: int) -> np.ndarray:
    """For each of the different fingerprints, the place of the first one it is linked with, through others or not.

    All pairs are compared, a tile at a time; nothing of a pair is kept but the smaller label.
    """
    label = np.arange(len(x))
    while True:
        before = label.copy()
        for i in range(0, len(x), TILE):
            for j in range(0, i + 1, TILE):
                near = np.bitwise_count(x[i : i + TILE, None] ^ x[None, j : j + TILE]) <= distance
                a, b = label[i : i + TILE], label[j : j + TILE]
                low = np.where(near, b[None, :], len(x)).min(1)
                np.minimum(a, low, out=a)
                low = np.where(near, a[:, None], len(x)).min(0)
                np.minimum(b, low, out=b)
        label = label[label]
        if (label == before).all():
            return label


def _links(distance):
    def run(batches):
        """Rows sorted by (mask, key) to a spanning forest of the links inside each key."""
        held = None
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if held is not None:
                now = [np.r_[a, b] for a, b in zip(held, now)]
            if not len(now[0]):
                continue
            new = np.flatnonzero(np.r_[True, (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])])
            held = [c[new[-1] :] for c in now]  # the last key may go on in the next batch
            yield from _forest(now[2][: new[-1]], new, distance)
        if held is not None:
            yield from _forest(held[2], np.array([0, len(held[2])]), distance)

    return run


def _forest(fp, bounds, distance):
    sizes = np.diff(bounds)
    a, b = [], []
    two = bounds[:-1][sizes == 2]
    near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
    a.append(fp[near]), b.append(fp[near + 1])
    for start, size in zip(bounds[:-1][sizes > 2], sizes[sizes > 2]):
        x = fp[start : start + size]
        label = tile_labels(x, distance)
        linked = np.flatnonzero(label != np.arange(size))
        a.append(x[label[linked]]), b.append(x[linked])
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b)], names=["a", "b"])


def close_fingerprints(fps: DataFrame, distance: int = DISTANCE, blocks=BLOCKS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough of them to keep every connection.

    Each fingerprint has a row for each choice of blocks; rows that agree on the chosen bits meet,
    and only those are compared. A group gives a spanning forest of its links, not its pairs.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks(blocks, distance))])
    rows = fps.select("fp", F.explode(keys).alias("s")).select(F.col("s.m").alias("m"), F.col("s.k").alias("k"), "fp")
    return rows.repartition("m", "k").sortWithinPartitions("m", "k", "fp").mapInArrow(_links(distance), "a bigint, b bigint")


def near_duplicates(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows with ``fp`` and a key, with ``component_id``: the smallest key that close fingerprints lead to.

    Copies are collapsed to distinct fingerprints before anything is compared. Null keys take part
    but are never the smallest, unless a component has no other; repeated rows stay; an empty table
    gives an empty one.
    """
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min(key).alias("low")))
    roots = cut_lineage(components(close_fingerprints(distinct.select("fp"))))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    of = placed.select("fp", "root").join(low, "root").select("fp", "component_id")
    return prints.join(of, "fp")


@query()
def op7_simhash(spark, sf_dir):
    prints = cut_lineage(fingerprints(table(spark, sf_dir, "documents", "doc_id", "text")))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_duplicates(prints).select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without near-duplicates of another: of each component the row of the smallest key stays.

    Columns are kept. Rows that repeat the smallest key go down to one; null keys come last.
    """
    (row,) = fresh(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    numbered = cut_lineage(numbered)
    prints = cut_lineage(fingerprints(numbered.select(row, key, text), text, keep=[row, key]))
    ranked = prints.select(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col(row).alias("r")).alias("at"), "fp")
    first = near_duplicates(ranked, "at").where(F.col("at") == F.col("component_id")).select(F.col("at.r").alias(row))
    return numbered.join(first, row, "left_semi").select(*docs.columns)
