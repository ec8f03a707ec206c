"""Filter interaction audit: what filters remove in every order, and which removals are redundant, unique or a loss."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, batches_of, cut_lineage, fresh, query, table

LETTERS = "ABCDE"
#: Counters of the duplicate sketch for each document, counters of one shard (a power of two), and counters each text adds to.
PER_DOCUMENT, SHARD, PLACES = 16, 1 << 20, 2
#: Bytes of the merged sketch up to which tasks get it whole; beyond, rows go to the shard they ask for.
BROADCAST = 64 << 20
_SPACE = "[\\x20\\x09-\\x0D]+"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the text fails filter A, B, C, D; one pass over the text's words."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, _SPACE), lambda w: w != "")

    def mask(found: Column) -> Column:
        n = F.size(found)
        capitals = F.length(t) - F.length(F.translate(t, UPPER, ""))
        tests = (n < 100, 100 * F.size(F.array_distinct(found)) < 80 * n, 100 * capitals > 10 * F.length(t), t.rlike(r"[#$%&*|]"))
        bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(tests)]
        return bits[0] + bits[1] + bits[2] + bits[3]

    # The words are bound once, for the two tests that use them.
    return F.transform(F.array(words), mask)[0]


# --- the counting sketch ------------------------------------------------------------------


def shards_for(rows: int) -> int:
    """A power of two, so that a shard is some bits of a hash."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows * PER_DOCUMENT / SHARD))))


def _places(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each hash, and its places there (one row for each of PLACES)."""
    h = hashes.view(np.uint64)
    return (h & np.uint64(shards - 1)).astype(np.int64), np.stack(
        [((h >> np.uint64(24 + 20 * k)) & np.uint64(SHARD - 1)).astype(np.int64) for k in range(PLACES)]
    )


def _count(shards):
    def run(batches):
        """Hashes of a task's texts to its own sketch: for each shard the places counted and their counts, 2 standing for more."""
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            if not len(hashes):
                continue
            shard, places = _places(hashes, shards)
            # A text whose places fall together counts once there.
            places[1][places[1] == places[0]] ^= 1
            place, count = np.unique(((shard << 20) | places).ravel(), return_counts=True)
            owner = place >> 20
            first = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
            bounds = pa.array(np.r_[first, len(owner)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner[first]), pa.ListArray.from_arrays(bounds, pa.array((place & (SHARD - 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(np.minimum(count, 2).astype(np.int8))),
                ],
                names=["shard", "places", "counts"],
            )

    return run


def _merge(batches):
    """Sketches sorted by shard to one row a shard: the places counted twice or more, as bits of 64-bit numbers."""
    shard, total = None, np.zeros(SHARD, np.uint8)

    def row():
        bits = np.packbits(total >= 2, bitorder="little").view("<i8")
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([bits], pa.list_(pa.int64()))], names=["shard", "bits"])

    for batch in batches:
        for k, now in enumerate(batch.column(0).to_pylist()):
            if now != shard:
                if shard is not None:
                    yield row()
                shard = now
                total[:] = 0
            places = batch.column(1)[k].values.to_numpy()
            total[places] = np.minimum(total[places] + batch.column(2)[k].values.to_numpy().view(np.uint8), 2)
    if shard is not None:
        yield row()


def repeat_sketch(hashes: DataFrame, rows: int) -> DataFrame:
    """(shard, bits): the merged counting sketch of a column of 64-bit hashes, cut down to "counted twice or more"."""
    shards = shards_for(rows)
    spark = hashes.sparkSession
    with batches_of(spark, rows=1 << 16, size=8 << 20):
        partial = hashes.mapInArrow(_count(shards), "shard bigint, places array<int>, counts array<tinyint>")
        dealt = partial.repartition("shard").sortWithinPartitions("shard")
        return cut_lineage(dealt.mapInArrow(_merge, "shard bigint, bits array<bigint>"))


def possible_repeats(rows: DataFrame, hash_col: str, sketch: DataFrame, n: int, limit: int = BROADCAST) -> DataFrame:
    """The rows whose hash may stand on another row too: all its places are counted twice or more.

    A row that is left out is the only one with its hash. The merged sketch is sent to tasks as long
    as its size, known from ``n``, is within ``limit``; beyond, rows meet their shard in a join.
    """
    shards = shards_for(n)
    shard, bits = fresh(rows, "shard", "bits")
    sketch = sketch.select(F.col("shard").alias(shard), F.col("bits").alias(bits))
    sketch = F.broadcast(sketch) if shards * SHARD // 8 <= limit else sketch.hint("merge")
    h = F.col(hash_col)
    first = F.shiftrightunsigned(h, 24).bitwiseAND(F.lit(SHARD - 1))
    second = F.shiftrightunsigned(h, 44).bitwiseAND(F.lit(SHARD - 1))
    second = F.when(first == second, second.bitwiseXOR(F.lit(1))).otherwise(second)
    hit = F.lit(True)
    for place in (first, second):
        word = F.element_at(F.col(bits), (F.shiftright(place, 6) + 1).cast("int"))
        hit = hit & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    placed = rows.withColumn(shard, h.bitwiseAND(F.lit(shards - 1)))
    return placed.join(sketch, shard).where(hit).drop(shard, bits)


# --- masks and orders ---------------------------------------------------------------------


def audit_masks(docs: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text", limit: int = BROADCAST) -> DataFrame:
    """(doc, part, mask, n): documents by key, part and failed filters, bit k standing for the letter k.

    Bits A to D come from one pass over the texts, which also leaves a hash of each. The hashes
    fill the sketch; the texts the sketch can't clear are read again and meet by their whole text,
    which gives each different one its smallest key. Copies are merged before they are sent, so a
    group of any size moves one row per task. A document fails E if it can't be cleared and its
    key is not the smallest of its text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    doc, kind = F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    rows = cut_lineage(docs.select(doc, kind, text_mask(F.col(text)).alias("mask"), F.xxhash64(t).alias("hash")))
    n = rows.count()
    sketch = repeat_sketch(rows.select("hash"), n)
    texts = docs.select(doc, t.alias("text"), F.xxhash64(t).alias("hash"))
    firsts = possible_repeats(texts, "hash", sketch, n, limit).groupBy("text").agg(F.min("doc").alias("doc"))
    firsts = firsts.select("doc", F.xxhash64("text").alias("hash"), F.lit(True).alias("first"))
    # The hash stands beside the key for keys on several rows with different texts.
    open_rows = possible_repeats(rows, "hash", sketch, n, limit).where("doc IS NOT NULL").groupBy("doc", "part", "mask", "hash").agg(F.count(F.lit(1)).alias("n"))
    later = open_rows.join(firsts, ["doc", "hash"], "left").where("first IS NULL")
    return (
        rows.select("doc", "part", "mask", F.lit(1).cast("bigint").alias("n"))
        .unionByName(later.select("doc", "part", (F.col("mask") + 16).alias("mask"), "n"))
        # A document that fails E leaves its row without E and stands with it.
        .unionByName(later.select("doc", "part", "mask", (-F.col("n")).alias("n")))
        .groupBy("doc", "part", "mask").agg(F.sum("n").alias("n")).where("n > 0")
    )


def mask_counts(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): additive counts. A document is good, or toxic, if any label of its key says so."""
    said = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("doc")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("bigint"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("bigint"), F.lit(0))).alias("toxic"),
    )
    n = F.col("n")
    counted = masks.join(said, "doc", "left").groupBy("part", "mask")
    return counted.agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce("good", F.lit(0))).alias("good"), F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )


def _permutations(letters: str) -> Column:
    """All orders of the letters as an array of strings, grown one letter at a time."""
    orders = F.array(F.lit(""))
    for _ in letters:
        orders = F.flatten(F.transform(orders, lambda o: F.transform(
            F.filter(F.array(*map(F.lit, letters)), lambda x: ~F.contains(o, x)), lambda x: F.concat(o, x))))
    return orders


def audit_orders(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counts by mask.

    Counts of a part are at most 2 ** len(letters) rows; each meets the steps of all orders in an
    explode, and sums are all that is left to do.
    """
    total = math.factorial(len(letters))
    bit = F.call_function("shiftleft", F.lit(1), F.instr(F.lit(letters), F.col("letter")) - 1)
    steps = counts.select("*", F.explode(_permutations(letters)).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    )
    steps = steps.withColumn("letter", F.substr("filter_order", F.col("step"), F.lit(1)))
    before = F.lit(0)
    for k in range(len(letters)):
        place = F.instr(F.col("filter_order"), letters[k])
        before = before + F.when(place < F.col("step"), 1 << k).otherwise(0)
    steps = steps.withColumns({"bit": bit, "earlier": F.col("mask").bitwiseAND(before)})
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("earlier") > 0

    def count(which: Column, of: Column = F.col("n")) -> Column:
        return F.sum(F.when(which, of).otherwise(0)).cast("bigint")

    # A document that fails f filters is removed by each of them in 1 / f of all orders.
    share = (F.lit(total) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("bigint")
    return steps.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        count(~fails & ~gone).alias("kept"),
        count(fails & ~gone).alias("removed"),
        count(fails & gone).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(fails & ~gone, F.col("good")).alias("good_lost"),
        count(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        count(fails, F.col("n") * share).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text", limit: int = BROADCAST) -> DataFrame:
    """How the five filters act on each other, in all 120 orders, for each value of ``part``.

    A: under 100 words; B: under 80 % different words; C: over 10 % capitals; D: holds one of
    ``#$%&*|``; E: a smaller key has the same text. Null texts are empty, a null part is ''. A
    document without a key is nobody's earlier copy and never a later one; rows that share key and
    text are not copies of each other. Equal labels of one key count once, and null labels say
    nothing. Other columns of either table are left out. An empty table has no parts and gives
    no rows. Texts of any length are handled whole.
    """
    return audit_orders(mask_counts(audit_masks(docs, part, key, text, limit), labels, key))


_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT doc_id, part, (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
      + 16 * coalesce(doc_id > first, false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
             list_sum(list_transform(range(1, step + 1), lambda k: 1 << (ascii(filter_order[k]) - 65))) - (1 << (ascii(filter_order[step]) - 65)) AS before
      FROM o, range(1, 6) r(step)),
j AS (SELECT *, mask & bit > 0 AS fails, mask & before::BIGINT > 0 AS gone FROM c, s),
r AS (SELECT part, filter_order, step::INT AS step, bit, sum(n) FILTER (NOT fails AND NOT gone) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
             sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
             sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost
      FROM j GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r
"""


@query(_SQL)
def op12_filter_audit(spark, sf_dir):
    return audit_filters(table(spark, sf_dir, "documents", "doc_id", "lang", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
