"""Mixing sources to target weights by systematic sampling of whole documents."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut_lineage, fresh, query, table

WEIGHTS = (5, 2, 1)
SHARE, CAP, SEED = 1.5, 2.0, 20260


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def offset(seed: int) -> float:
    """The random offset, on a grid so fine that sums with whole numbers stay exact."""
    return random.Random(seed).randrange(1, 1 << 20) / (1 << 20)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Targets of (source, source_size): ``share`` of all sizes by weight, none above ``cap`` times its size.

    The excess of a capped source goes to the others by weight. In the order of cap by weight the
    capped sources come first, so the level that the others reach follows from running sums. One
    row for each source; weights repeat over the sources by code point, null last.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weighed = sizes.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    ).withColumn("top", F.col("source_size") * F.lit(cap))
    rise = W.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("top").over(rise), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(rise), F.lit(0.0))
    )
    leveled = weighed.withColumn("level", level).withColumn("capped", F.col("top") / F.col("w") <= F.col("level"))
    reach = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return leveled.select("source", "source_size", F.when(F.col("capped"), F.col("top")).otherwise(reach * F.col("w")).alias("target"))


def mix(
    docs: DataFrame, size: Column, *, source: str = "source", key: str = "doc_id", ties: Column | None = None,
    weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with size, source_size, target and copies; the dict names these columns.

    Each document of a source expects target / source_size copies. The expected copies are added
    up within the source, largest documents first, one random offset is added, and a document is
    taken once for every whole number its stretch crosses. The order by size keeps the words taken
    within the size of one large document of the target.

    Rows are dealt out by range of (source, size, key), so a source of any share lies on many
    tasks; a task numbers its own rows and a summary of one row per task and source shifts them.
    Null sizes count 0; a source without words has target 0 and is not taken; a null source is a
    source; rows that share key, size and ``ties`` may change places; an empty table gives an empty
    one. Columns of the input keep their names, ours step aside.
    """
    z, pos, n_src, tgt, cop = fresh(docs, "size", "pos", "source_size", "target", "copies")
    sized = docs.withColumn(z, F.coalesce(size, F.lit(0)).cast("bigint"))
    order = [F.col(source), F.col(z).desc(), F.col(key)] + ([ties] if ties is not None else [])
    placed = cut_lineage(sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(pos, F.monotonically_increasing_id()))

    part = F.shiftright(F.col(pos), 33)
    runs = placed.groupBy(F.col(source).alias("source"), part.alias("part")).agg(F.count("*").alias("n"), F.min(pos).alias("first"), F.sum(z).alias("words"))
    runs = cut_lineage(runs)
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    targets = source_targets(runs.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    t = targets.select(F.col("source").alias("_s"), F.col("source_size").alias("_n"), F.col("target").alias("_t"))
    shifts = runs.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(F.col("part").alias("_p"), "before", "_s", "_n", "_t")

    u = F.lit(offset(seed))
    at = F.col(pos) + F.col("before")
    rate = F.when(F.col("_n") > 0, F.col("_t") / F.col("_n")).otherwise(F.lit(0.0))
    copies = F.floor((at + 1) * rate + u) - F.floor(at * rate + u)
    mixed = placed.join(shifts, (part == F.col("_p")) & F.col(source).eqNullSafe(F.col("_s")))
    out = mixed.select(*docs.columns, z, F.col("_n").alias(n_src), F.col("_t").alias(tgt), copies.cast("bigint").alias(cop))
    return out, {"size": z, "source_size": n_src, "target": tgt, "copies": cop}


def repeat_copies(mixed: DataFrame, copies: str, columns: list[str]) -> DataFrame:
    """Each row as often as the mix takes it, with its copy number from 1."""
    (nr,) = fresh(mixed, "copy_no")
    return mixed.where(F.col(copies) > 0).withColumn(nr, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*columns, nr)


_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS top,
             [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS w
      FROM d GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * {SHARE}::DOUBLE - coalesce(sum(top) OVER r, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER r, 0)) AS level
      FROM s WINDOW r AS (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN top / w <= level THEN top ELSE w * max(CASE WHEN top / w > level THEN level END) OVER () END AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS FIRST) AS rn
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rn * rate + {offset(SEED)!r}::DOUBLE) - floor((rn - 1) * rate + {offset(SEED)!r}::DOUBLE)) * size)::BIGINT AS taken FROM p
"""


@query(_SQL)
def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed, c = mix(cut_lineage(sized), F.col("words"))
    return mixed.select("doc_id", F.col(c["size"]).alias("size"), F.col(c["source_size"]).alias("source_size"), F.col(c["target"]).alias("target"), (F.col(c["copies"]) * F.col(c["size"])).alias("taken"))
