"""Continuous form of the batch run: only new notice files, progress kept per micro-batch."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cascade import pending
from ..plans.extract import MANIFEST, Table, extract, write_extraction
from ..sources.files import read_file_index
from ..sources.notices import stream_notices
from ..sources.results import RUN, read_manifest
from ..sources.shared import cut_lineage


def run_incremental(
    spark: SparkSession,
    notices_path: str,
    files_root: str | None,
    pages: Table,
    answers: Table,
    out: str,
    checkpoint: str,
    files: DataFrame | None = None,
    bundled: bool = False,
    max_files_per_trigger: int = 10_000,
    prefix: str = "stream",
) -> StreamingQuery:
    """Process the files that are there and not yet processed, then stop.

    A micro-batch writes under its own run name, so a batch that is repeated after a crash
    replaces what it had written. Notices with a result of another run are left alone.
    Give ``pages`` and ``answers`` as functions (``by_notice``), and a micro-batch reads only the
    folders its notices lie in. Refused notices are in the reject table; ``run_batch`` on the same folder tries them again.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        run = f"{prefix}-{batch_id}"
        done = read_manifest(batch.sparkSession, f"{out}/{MANIFEST}")
        notices = batch if done is None else pending(batch, done.where(F.col(RUN) != run))
        index = files if files is not None else partial(read_file_index, batch.sparkSession, files_root)
        result = extract(notices, index, pages, answers, files_root or "downloads", keep=cut_lineage)
        write_extraction(result, out, run)

    stream = stream_notices(spark, notices_path, bundled, max_files_per_trigger)
    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
