"""The training-corpus pipeline: toxic documents go, repeated lines go, one of near-copies stays, contaminated ones go, sources are mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlines.llm import decontamination, lines, mixing, simhash, toxicity
from bidlines.llm.common import cut_lineage, fresh, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(toxicity.labelled(spark, sf_dir))
    (score,) = fresh(docs, "score")
    return toxicity.score(docs, model, name=score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, told apart by ``copy_no``."""
    mixed, names = mixing.mix(docs, mixing.word_count(F.col("text")), ties=F.xxhash64("text"))
    return mixing.repeat_copies(mixed, names["copies"], docs.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` after all stages, each written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
