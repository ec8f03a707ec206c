"""The shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session whose tasks all run in the driver gets a fresh local folder; any
    other is refused, since its executors would each write to a disk of their own.
    """
    configured = spark.conf.get(_DIR, None) or spark.sparkContext.getConf().get(_DIR, None)
    if not configured:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError(f"{_DIR} is not set: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="bidlines-")
        spark.conf.set(_DIR, configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there.

    It is computed once, later branches read only the columns they need, and nothing of it is
    lost with an executor. The shuffle files it took are no longer needed then, and are deleted.
    """
    spark = df.sparkSession
    path = new_path(spark, "kept")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame) -> DataFrame:
    """Marks a side of a join by key that has rows in number with the input: it is shuffled, and never sent whole to the driver.

    Spark tells small frames by the size of files and shuffles. Those are compressed, and names that count up
    compress very well: 10 MB of them are over 100 MB once broadcast.
    """
    return df.hint("merge")


def discard(kept: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for this frame, once no frame that reads it is needed any more."""
    spark = kept.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in kept.inputFiles()}:
        if not re.search(r"/kept-[0-9a-f]{32}$", folder):
            raise ValueError(f"{folder} is not a folder of a kept frame")
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
