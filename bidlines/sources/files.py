"""Listing of attachment files.

Spark's own file sources leave out empty files, and those must be found and reported. So
tasks list the folders, each task its share of them, through Arrow's file systems (local,
HDFS, S3, GCS). Only names and sizes are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..schemas import FILES


#: Files found in small folders that go on in one piece.
FILES_AT_ONCE = 4096


def open_root(root: str):
    """The file system of a root, and the root's path in it."""
    from pyarrow import fs

    uri = root.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri)


def _subfolders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for root in batch["root"]:
            system, path = open_root(root)
            names = [i.base_name for i in system.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.Directory]
            yield pd.DataFrame({"folder": names})


def _listed(found: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["folder", "file_name", "path", "length"]).astype({"length": "Int64"})


def _lister(root: str):
    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = open_root(root)
        for batch in batches:
            found = []
            for folder in batch["folder"]:
                place = f"{base}/{folder}"
                if system.get_file_info(place).type != fs.FileType.Directory:
                    continue
                files = [i for i in system.get_file_info(fs.FileSelector(place)) if i.type == fs.FileType.File]
                found += [(folder, i.base_name, f"{root}/{folder}/{i.base_name}", i.size) for i in files] or [(folder, None, f"{root}/{folder}", None)]
                if len(found) >= FILES_AT_ONCE:
                    yield _listed(found)
                    found = []
            if found:
                yield _listed(found)

    return list_folders


def read_file_index(
    spark: SparkSession, root: str, folders: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """``folder, file_name, path, length`` of the files in the folders right under ``root``.

    ``folders`` (column ``folder``) limits the listing to folders that are asked for; those that
    do not exist give no row. A folder without files gives one row with a null ``file_name``.
    """
    root = root.rstrip("/")
    if folders is None:
        folders = spark.createDataFrame([(root,)], "root string").mapInPandas(_subfolders, "folder string")
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    spread = folders.select("folder").distinct().repartition(tasks, "folder")
    return spread.mapInPandas(_lister(root), FILES)
