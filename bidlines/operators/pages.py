"""Attachments held page by page.

An attachment may have any number of pages. One that is short, in characters and in pages, is put together
and parsed as one text. The text of any other is never put together as a whole: one pass leaves a few facts of each page; a scan over the facts tells in which page each
page's first block began and which blocks can be items at all; then only the fragments of one
such block, or of one composition section, meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import first_group, split_at, strip
from ..sources.shared import cut_lineage, keyed
from .groups import group_mapping, group_mapping_of_sections, with_group_mapping
from .items import attachment_blocks, items_of_attachment_blocks
from .ordered import PART_CHARS, numbered, ordered_text, task_of, with_summary

#: Characters of an attachment that is put together, at most; and words of 64 bits that hold its page numbers, each as one bit.
WHOLE_CHARS = 1 << 20
PAGE_WORDS = 4


def join_pages(
    pages: DataFrame, keys: Sequence[str], page_col: str = "page_no", text_col: str = "text", part_chars: int = PART_CHARS
) -> DataFrame:
    """Page texts in page order, joined by a newline; null text is ''. See ``ordered_text`` for parts."""
    return ordered_text(pages, keys, [page_col], text_col, "\n", part_chars=part_chars)


def _fragments(text: Column, crosses: Column | None = None) -> Column:
    """A page cut where items start. Fragment 0 belongs to what began on an earlier page.

    ``crosses`` tells that the number at the page's end goes on with a dash on a later page.
    """
    lead = F.concat(F.lit("\n"), text)
    plain = split_at(lead, P.ITEM_START)
    if crosses is None:
        return plain
    return F.when(crosses, split_at(lead, rf"{P.ITEM_START}|\n(?=\d+{P.WS}*\z)")).otherwise(plain)


def page_facts(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The few facts of each page that tell how it hangs together with other pages; one pass, without text.

    ``starts``: item starts; ``open_end``: it ends with a number; ``head``: first character that is
    no blank; ``first_counts``, ``last_counts``: its first and last fragment say "quantidade";
    ``first_filled``, ``first_number``: the first fragment is not blank, and begins with a number;
    ``heads``: a group composition begins; ``ends_own``, ``ends_any``: a composition that begins
    here, or went on from before, ends here.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ended = F.concat(text, F.lit("\n"))
    heading = ended.rlike(P.GROUP_HEADING)
    body = F.regexp_extract(ended, rf"{P.GROUP_HEADING}((?s:.*))", 1)

    def of_fragments(f: Column) -> Column:
        bare = F.ltrim(f[0], F.lit(P.BLANKS))
        return F.struct(
            (F.size(f) - 1).alias("starts"),
            f[0].rlike(P.QUANTITY_WORD).alias("first_counts"),
            F.element_at(f, -1).rlike(P.QUANTITY_WORD).alias("last_counts"),
            (bare != "").alias("first_filled"),
            bare.rlike(rf"\A\d+{P.WS}*(?:-|\z)").alias("first_number"),
        )

    # The fragments are bound once: five facts read them.
    cut = F.transform(F.array(_fragments(text)), of_fragments)[0]
    facts = pages.select(
        *keys,
        "page_no",
        cut.alias("cut"),
        F.concat(F.lit("\n"), text).rlike(rf"\n\d+{P.WS}*\z").alias("open_end"),
        F.nullif(F.substring(strip(text), 1, 1), F.lit("")).alias("head"),
        heading.alias("heads"),
        (heading & body.rlike(P.GROUP_SECTION_END)).alias("ends_own"),
        F.concat(F.lit("\n"), text).rlike(P.GROUP_SECTION_END).alias("ends_any"),
    )
    return facts.select(*keys, "page_no", "cut.*", "open_end", "head", "heads", "ends_own", "ends_any")


def page_owners(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Page facts with ``crosses`` (the number at the page's end goes on with the dash of a later page),
    ``own_no`` (blocks that begin on the page) and ``owner``, the page and block of the text at its start.

    Each task reads its pages forwards and backwards; what it hands on is one row per text. Before
    the first item start the owner is page 0, block 0.
    """
    facts = facts.withColumn("_task", task_of())
    here = Window.partitionBy(*keys, "_task")
    before = (Window.unboundedPreceding, -1)
    # What follows is looked up backwards: a frame that is open at its end is quadratic.
    from_end = here.orderBy(F.desc("_row")).rowsBetween(*before)
    near = facts.withColumn("_next_in", F.last("head", ignorenulls=True).over(from_end))
    known = F.col("starts") + F.when(F.col("open_end") & (F.col("_next_in") == "-"), 1).otherwise(0)
    near = near.withColumn("_known", known)
    owner = F.struct(F.col("page_no").alias("page"), F.col("_known").alias("block"))
    pending = F.col("open_end") & F.col("_next_in").isNull()
    pieces = near.groupBy(*keys, "_task").agg(
        F.min_by("head", F.when(F.col("head").isNotNull(), F.col("_row"))).alias("first_head"),
        F.max(F.when(F.col("_known") > 0, F.struct("_row", owner.alias("o")))).alias("last_owner"),
        F.max(F.when(pending, F.struct("_row", owner.alias("o")))).alias("pending"),
    )
    over = Window.partitionBy(*keys).orderBy("_task")
    backwards = Window.partitionBy(*keys).orderBy(F.desc("_task")).rowsBetween(*before)
    pieces = pieces.withColumn("_next_head", F.last("first_head", ignorenulls=True).over(backwards))
    crossed = F.struct(F.col("pending.o.page").alias("page"), (F.col("pending.o.block") + 1).alias("block"))
    last = F.when(F.col("pending").isNotNull() & (F.col("_next_head") == "-"), crossed).otherwise(F.col("last_owner.o"))
    pieces = pieces.withColumn("_last", last).select(
        *keys, "_task", "_next_head", F.last("_last", ignorenulls=True).over(over.rowsBetween(*before)).alias("_carried")
    )
    met = with_summary(near, pieces, keys)
    crosses = F.col("open_end") & F.coalesce(F.coalesce(F.col("_next_in"), F.col("_next_head")) == "-", F.lit(False))
    met = met.withColumn("crosses", crosses)
    met = met.withColumn("own_no", F.col("starts") + F.col("crosses").cast("int"))
    own = F.when(F.col("own_no") > 0, F.struct(F.col("page_no").alias("page"), F.col("own_no").alias("block")))
    found = F.coalesce(F.last(own, ignorenulls=True).over(here.orderBy("_row").rowsBetween(*before)), F.col("_carried"))
    none = F.struct(F.lit(0).cast(met.schema["page_no"].dataType).alias("page"), F.lit(0).alias("block"))
    columns = [c for c in met.columns if not c.startswith("_")]
    return met.select(*columns, F.coalesce(found, none).alias("owner"))


def _wanted_ends(owned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, page_no, crosses, own_no, owner, want_first, want_last``: whether the first and the last fragment
    of a page belong to blocks that can be items.

    A block can be one if any of its fragments says "quantidade"; the text before the first start
    must also begin with a number. Decided on the facts, so no text of other blocks is ever gathered.
    """
    first = F.struct(
        F.lit(True).alias("first"), F.col("owner.page").alias("page"), F.col("owner.block").alias("block"),
        F.col("first_counts").alias("counts"), F.when(F.col("first_filled"), F.col("first_number")).alias("number"),
    )
    last = F.struct(
        F.lit(False).alias("first"), F.col("page_no").alias("page"), F.col("own_no").alias("block"),
        (F.col("last_counts") & ~F.col("crosses")).alias("counts"), F.lit(None).cast("boolean").alias("number"),
    )
    ends = owned.select(*keys, "page_no", F.inline(F.when(F.col("own_no") > 0, F.array(first, last)).otherwise(F.array(first))))
    block = [*keys, "page", "block"]
    opening = F.min_by("number", F.when(F.col("number").isNotNull(), F.col("page_no")))
    good = ends.groupBy(*block).agg(F.max("counts").alias("counts"), opening.alias("number"))
    good = good.where(F.col("counts") & ((F.col("page") > 0) | F.coalesce("number", F.lit(False))))
    wanted = ends.join(keyed(good.select(*block)), block, "left_semi").groupBy(*keys, "page_no").agg(
        F.max("first").alias("want_first"), F.max(~F.col("first")).alias("want_last")
    )
    return owned.select(*keys, "page_no", "crosses", "own_no", "owner").join(keyed(wanted), [*keys, "page_no"], "left")


def paged_blocks(pages: DataFrame, keys: Sequence[str], facts: DataFrame | None = None) -> DataFrame:
    """Blocks of paged attachments that may be items: ``keys``, ``block_pos``, ``block``, as if the pages were one text.

    ``pages`` holds ``keys``, ``page_no`` (unique, from 1), ``text``. ``block_pos`` orders by
    page, then block; 0 is the text before the first item start. Blocks that don't say
    "quantidade" are left out. ``facts`` are the numbered facts of the pages, if they are at hand.
    """
    if facts is None:
        facts = numbered(page_facts(pages, keys), [*keys, "page_no"])
    wanted = _wanted_ends(page_owners(facts, keys), keys)
    # Both sides have a row per page, so neither is ever the small one.
    owned = pages.select(*keys, "page_no", "text").join(keyed(wanted), [*keys, "page_no"])
    cut = _fragments(F.coalesce(F.col("text"), F.lit("")), F.col("crosses"))
    fragments = owned.select(*keys, "page_no", "owner", "own_no", "want_first", "want_last", F.posexplode_outer(cut).alias("no", "fragment"))
    want = (
        F.when(F.col("no") == 0, F.col("want_first"))
        .when(F.col("no") == F.col("own_no"), F.col("want_last"))
        .otherwise(F.col("fragment").rlike(P.QUANTITY_WORD))
    )
    own = F.col("no") > 0
    fragments = fragments.where(want & (F.col("fragment") != "")).select(
        *keys,
        "page_no",
        "fragment",
        F.when(own, F.col("page_no")).otherwise(F.col("owner.page")).alias("start_page"),
        F.when(own, F.col("no")).otherwise(F.col("owner.block")).alias("start_no"),
    )
    piece = F.struct("page_no", "fragment")
    return (
        fragments.groupBy(*keys, "start_page", "start_no")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
        .select(
            *keys,
            (F.shiftleft(F.col("start_page").cast("bigint"), 32) + F.col("start_no")).alias("block_pos"),
            strip(F.array_join("pieces.fragment", "")).alias("block"),
        )
    )


def paged_group_mapping(pages: DataFrame, keys: Sequence[str], facts: DataFrame | None = None) -> DataFrame:
    """Group mapping of paged attachments. The pages of a section are known from the facts.

    Of a section that no item ends, which is the rest of the document, only what can name a group or
    an item of one is put together: runs of other lines are a single dot.
    """
    facts = page_facts(pages, keys) if facts is None else facts
    heads = facts.where("heads").groupBy(*keys).agg(F.min(F.struct("page_no", "ends_own")).alias("first"))
    heads = heads.select(*keys, F.col("first.page_no").alias("first_page"), F.col("first.ends_own").alias("ends_own"))
    later = facts.where("ends_any").join(keyed(heads.where("NOT ends_own")), list(keys)).where("page_no > first_page")
    ends = later.groupBy(*keys).agg(F.min("page_no").alias("last_page"))
    last = F.when(F.col("ends_own"), F.col("first_page")).otherwise(F.col("last_page"))
    spans = heads.join(keyed(ends), list(keys), "left").select(*keys, "first_page", last.alias("last_page"))
    inside = (F.col("page_no") >= F.col("first_page")) & (F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page")))
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.regexp_replace(F.concat(F.lit("\n"), text), P.GROUP_IDLE_LINES, "\n.")
    text = F.when((F.col("page_no") > F.col("first_page")) & F.col("last_page").isNull(), F.substr(bare, F.lit(2))).otherwise(text)
    sections = (
        pages.select(*keys, "page_no", "text").join(keyed(spans), list(keys)).where(inside)
        .select(*keys, "page_no", text.alias("text"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("pieces"))
        .select(*keys, first_group(F.array_join("pieces.text", "\n"), P.GROUP_SECTION).alias("section"))
    )
    return group_mapping_of_sections(sections.where("section IS NOT NULL"), keys)


def long_attachments(pages: DataFrame, keys: Sequence[str], whole_chars: int = WHOLE_CHARS) -> DataFrame:
    """``keys`` of the attachments that are not put together: too long, too many pages, or page numbers that are null or repeated."""
    no = F.col("page_no")

    def bits(word: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (no - 64 * word).cast("int"))
        return F.bit_or(F.when(no.between(64 * word, 64 * word + 63), bit))

    words = [f"_w{i}" for i in range(PAGE_WORDS)]
    sizes = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.length(F.coalesce("text", F.lit(""))) + F.lit(1)).alias("_chars"),
        *[bits(i).alias(w) for i, w in enumerate(words)],
    )
    numbers = sum((F.bit_count(F.coalesce(w, F.lit(0).cast("bigint"))) for w in words), F.lit(0))
    return sizes.where((numbers != F.col("_n")) | (F.col("_chars") > whole_chars)).select(*keys)


def whole_texts(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, ``text``: attachments put together, one row each. For short ones only."""
    page = F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))
    met = pages.groupBy(*keys).agg(F.sort_array(F.collect_list(page)).alias("pages"))
    return met.select(*keys, F.array_join("pages.text", "\n").alias("text"))


def parse_paged_attachments(pages: DataFrame, keys: Sequence[str], whole_chars: int = WHOLE_CHARS) -> DataFrame:
    """Items of attachments held as pages, with their lots; none of null keys.

    The pages are read once for the sizes of attachments. Short attachments are parsed as one text; the pages of
    long ones are read three times: for their facts, for blocks that can be items, and for the
    sections that name groups. ``block_pos`` orders the blocks of one attachment.
    """
    pages = pages.dropna(subset=list(keys))
    far = cut_lineage(long_attachments(pages, keys, whole_chars))
    if far.isEmpty():
        return parse_attachment_items(whole_texts(pages, keys), keys)
    near = pages.join(keyed(far), list(keys), "left_anti")
    return parse_attachment_items(whole_texts(near, keys), keys).unionByName(
        _parse_by_page(pages.join(keyed(far), list(keys), "left_semi"), keys)
    )


def _parse_by_page(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    facts = numbered(page_facts(pages, keys), [*keys, "page_no"])
    items = items_of_attachment_blocks(paged_blocks(pages, keys, facts), keys)
    return with_group_mapping(items, paged_group_mapping(pages, keys, facts), keys)


def parse_attachment_items(df: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """Items of attachments held as one text per row, with their lots."""
    items = items_of_attachment_blocks(attachment_blocks(df, keys, text_col), keys)
    return with_group_mapping(items, group_mapping(df, keys, text_col), keys)
