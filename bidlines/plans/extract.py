"""The extraction plan: from notices, files, page texts and model answers to result tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators.attachments import (
    REF,
    attachment_failures,
    processed_attachments,
    relevant_attachments,
    resolve_attachments,
    usable,
)
from ..operators.cascade import cascade, pending, unsolved
from ..operators.items import clean_items, parse_notice_items
from ..operators.nesting import nest_notices
from ..operators.pages import parse_paged_attachments
from ..operators.quality import reject_reasons, valid_notice
from ..operators.rescue import PIECE, rescue_queue, rescued_items, unanswered
from ..schemas import ITEM_FIELDS, NOTICE_FIELDS
from ..sources.files import read_file_index
from ..sources.notices import explode_attachments, notice_header, read_notices
from ..sources.results import RUN, read_checkpoint, read_manifest, read_table, with_earlier_rows, write_manifest, write_results
from ..sources.shared import cut_lineage, keyed

ITEMS, NOTICES, FAILURES, REJECTS, QUEUE, MANIFEST = "itens", "licitacoes", "falhas", "rejeitados", "fila", "manifesto"


#: A table, or a function that gives its rows for a frame of notices (``sources.layout.by_notice``).
Table = DataFrame | Callable[[DataFrame], DataFrame]


class Extraction(NamedTuple):
    """Flat items (with ``tier``), nested result rows, attachment failures, refused notices, pieces to be asked about."""

    items: DataFrame
    notices: DataFrame
    failures: DataFrame
    rejects: DataFrame
    queue: DataFrame | None = None


def extract(
    notices: DataFrame,
    files: DataFrame | Callable[[DataFrame], DataFrame],
    pages: Table,
    answers: Table,
    root: str = "downloads",
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    texts: DataFrame | None = None,
    piece_chars: int = P.RESCUE_CHARS,
) -> Extraction:
    """Plan the extraction for a set of notices.

    ``files`` is a file index, or a function that lists the folders of the frame it is given;
    ``pages`` and ``answers`` are tables, or functions that read them for the notices they are given.
    A source is parsed only for notices that the sources before it left without items. ``keep``
    is applied to what several branches read: pass ``cut_lineage`` to parse it only once.

    ``answers`` may name the piece of the text they are to in ``trecho``. With ``texts`` (the
    Markdown of attachments: ``arquivo_json, att_pos, text``), the pieces of usable attachments that
    no answer row is there for are the ``queue``, and their notices have no result before all
    their pieces are answered.
    """
    header = keep(notice_header(notices))
    readable = header.where(F.size("ilegivel") == 0)
    writable = readable.where(valid_notice(with_items=False))
    refused = header.withColumn("motivos", F.concat("ilegivel", reject_reasons(with_items=False))).where(
        F.size("motivos") > 0
    )

    # Several joins read the references.
    refs = keep(relevant_attachments(explode_attachments(notices)).join(
        keyed(readable.select("arquivo_json")), "arquivo_json", "left_semi"
    ))
    if callable(files):
        files = keep(files(refs.select("folder")))
    resolved = keep(resolve_attachments(refs, files))
    opened = usable(resolved)
    pdf = opened.where(F.lower("file_name").rlike(r".\.pdf\z"))

    wanted = writable.select("arquivo_json")
    # The parser reads the pages several times; this way they are picked and moved only once.
    pdf_refs = pdf.select(*REF).join(keyed(wanted), "arquivo_json", "left_semi")
    pages = pages(pdf_refs) if callable(pages) else pages
    answers = answers(opened) if callable(answers) else answers
    pdf_pages = keep(pages.join(keyed(pdf_refs), list(REF), "left_semi"))
    fields = ("arquivo_json", "att_pos", "block_pos", *ITEM_FIELDS)

    def from_pages(left: DataFrame) -> DataFrame:
        return clean_items(parse_paged_attachments(pdf_pages, REF)).select(*fields)

    def from_answers(left: DataFrame) -> DataFrame:
        asked = answers.join(keyed(opened.select(*REF)), list(REF), "left_semi").join(keyed(left.select("arquivo_json")), "arquivo_json", "left_semi")
        return clean_items(rescued_items(asked, REF, keep)).select(*fields)

    def from_notice(left: DataFrame) -> DataFrame:
        return parse_notice_items(left, ["arquivo_json"]).withColumn("att_pos", F.lit(0)).select(*fields)

    queue = None
    if texts is not None:
        solved = keep(from_pages(writable))
        usable_texts = texts.join(keyed(opened.select(*REF)), list(REF), "left_semi").join(keyed(wanted), "arquivo_json", "left_semi")
        queue = keep(unanswered(rescue_queue(usable_texts, solved, size=piece_chars), answers, REF))
        writable = unsolved(writable, queue)
        tier1 = solved
    else:
        tier1 = from_pages
    items = keep(cascade(writable, tier1, from_answers, from_notice, keep=keep))
    return Extraction(
        items=items,
        notices=nest_notices(writable, processed_attachments(resolved), items),
        failures=attachment_failures(resolved, root),
        rejects=refused.select(*NOTICE_FIELDS, "motivos"),
        queue=queue if queue is None else queue.select(*REF, PIECE, "text"),
    )


def write_extraction(
    result: Extraction, out: str, run: str, reset: bool = False, anew: bool = False, again: DataFrame | None = None
) -> None:
    """Write the tables of a run. The manifest comes last: it is what marks notices as done.

    ``reset`` drops earlier results; earlier failures and refusals go only with ``anew``. Where the
    run has written before, ``again`` names the notices that are done again: rows of others stay.
    """
    def rows(name: str, df: DataFrame, drop: bool) -> DataFrame:
        return df if again is None or drop else with_earlier_rows(df, f"{out}/{name}", run, again)

    write_results(rows(ITEMS, result.items, reset), f"{out}/{ITEMS}", run, reset)
    failures = result.failures.select(F.current_timestamp().alias("ts"), "arquivo_json", "anexo", "motivo")
    write_results(rows(FAILURES, failures, anew), f"{out}/{FAILURES}", run, anew)
    write_results(rows(REJECTS, result.rejects, anew), f"{out}/{REJECTS}", run, anew)
    if result.queue is not None:
        write_results(result.queue, f"{out}/{QUEUE}", run, reset)
    write_results(rows(NOTICES, result.notices, reset), f"{out}/{NOTICES}", run, reset)
    write_manifest(result.items.sparkSession, f"{out}/{NOTICES}", f"{out}/{MANIFEST}", run, reset)


def done_before(spark: SparkSession, out: str) -> DataFrame:
    """``arquivo_json, execucao`` of the notices that have a result. Results from before there was a manifest are validated once."""
    done = read_manifest(spark, f"{out}/{MANIFEST}")
    if done is not None:
        return done
    return read_checkpoint(spark, f"{out}/{NOTICES}", run_column=True).select("arquivo_json", RUN)


def read_finished(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame | None:
    """The rows of a result table that finished runs have written; null if there is no such table."""
    rows = read_table(spark, f"{out}/{name}", f"{schema}, {RUN} string")
    return None if rows is None else rows.join(keyed(done_before(spark, out)), ["arquivo_json", RUN], "left_semi")


def run_batch(
    spark: SparkSession,
    notices_path: str,
    files_root: str,
    pages: Table,
    answers: Table,
    out: str,
    run: str,
    resume: bool = True,
    bundled: bool = False,
    files: DataFrame | None = None,
    texts: DataFrame | None = None,
    piece_chars: int = P.RESCUE_CHARS,
) -> None:
    """Process the notices that have no result yet; refused ones are tried again on every run.

    The folders under ``files_root`` are listed unless a file index is given as ``files``.
    ``resume=False`` drops earlier results, failures and refusals. An invalid row among the results,
    which the manifest tells, drops the results only, as its notices are then all processed again. A run
    name used before does that run's notices again together with new ones; what it had written
    about notices that are no longer in the folder stays.

    With ``texts`` the run also writes the queue of pieces to be asked about, and leaves their notices
    to a later run that has the answers.
    """
    done = done_before(spark, out)
    reset = not resume or done.isEmpty()
    notices = read_notices(spark, notices_path, bundled)
    if not reset:
        notices = pending(notices, done.where(F.col(RUN) != run))
    # Names, headers and references are read from it, so the JSON is parsed, and met with what is done, only once.
    notices = cut_lineage(notices)
    again = cut_lineage(notices.select("arquivo_json").distinct())
    index = files if files is not None else partial(read_file_index, spark, files_root)
    result = extract(notices, index, pages, answers, files_root, cut_lineage, texts, piece_chars)
    write_extraction(result, out, run, reset, anew=not resume, again=again)
