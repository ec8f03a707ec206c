"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, query, table

#: Long texts have paragraphs and sections of their own content, besides those of their layout. A
#: section ends behind an empty line, before a heading, and behind a sentence whose third letter
#: from the end is an a or i. A paragraph ends behind a line, a sentence, and a word that ends in a
#: vowel and a letter up to m. Both depend on the characters at the cut alone, so an edit
#: moves no cuts but those beside it.
SECTION = r"(?<=\n[ \t]{0,9}\n)(?=\S)|(?<=\n)(?=#)|(?<=[ai]..[.!?])(?= )"
PARAGRAPH = r"(?<=[\n。！？])|(?<=[.!?])(?= )|(?<=[aeiou][a-m])(?= )"
#: Bits of a leaf that hold its length; longer paragraphs count as this long in a likeness.
LENGTH_BITS = 20
#: Documents of a span in the order of keys (fewer than a window keeps in memory), and spans at most.
SPAN_ROWS, MOST_SPANS = 1024, 1 << 18


def merkle_tree(text: Column) -> Column:
    """``root`` and ``nodes`` of a text: one node per section, with one leaf per paragraph.

    The digest of a paragraph is the SHA-256 of its text, that of a section the SHA-256 of its
    paragraphs' digests, and the root, in hex, the SHA-256 of the sections' digests. Nodes keep 64
    bits of their digests for comparison, leaves 44 bits and their length. Null is as empty: no
    sections, and the root of nothing.
    """
    t = F.coalesce(text, F.lit(""))

    def leaf(p: Column, digest: Column) -> Column:
        size = F.least(F.length(p), F.lit((1 << LENGTH_BITS) - 1)).cast("bigint")
        return F.shiftleft(F.xxhash64(digest), LENGTH_BITS).bitwiseOR(size)

    def section(paragraphs: Column) -> Column:
        pieces = F.filter(paragraphs, lambda p: p != "")
        digests = F.transform(pieces, lambda p: F.struct(F.sha2(p, 256).alias("d"), p.alias("p")))
        return F.transform(
            F.array(digests),
            lambda ds: F.struct(
                F.sha2(F.array_join(ds["d"], ""), 256).alias("d"), F.transform(ds, lambda x: leaf(x["p"], x["d"])).alias("leaves")
            ),
        )[0]

    sections = F.transform(F.filter(F.split(t, SECTION), lambda s: s != ""), lambda s: section(F.split(s, PARAGRAPH)))
    # Bound once: the root and the nodes read the same sections.
    return F.transform(
        F.array(sections),
        lambda ss: F.struct(
            F.sha2(F.array_join(ss["d"], ""), 256).alias("root"),
            F.transform(ss, lambda s: F.struct(F.xxhash64(s["d"]).alias("digest"), s["leaves"].alias("leaves"))).alias("nodes"),
        ),
    )[0]


def _length(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("bigint"), lambda n, leaf: n + leaf.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)))


def _leaves(nodes: Column) -> Column:
    return F.flatten(F.transform(nodes, lambda n: n["leaves"]))


def _opened(nodes: Column, other: Column) -> Column:
    """Leaves of the sections that the other tree does not have."""
    lost = F.array_except(F.transform(nodes, lambda n: n["digest"]), F.transform(other, lambda n: n["digest"]))
    return F.transform(F.array(lost), lambda gone: _leaves(F.filter(nodes, lambda n: F.array_contains(gone, n["digest"]))))[0]


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of two trees' characters that lie in paragraphs both have; 1 if their roots are equal.

    Sections with equal digests are not opened: their characters are shared. Of the others the
    different paragraphs are compared, each counting once for a tree.
    """
    def met(pair: Column) -> Column:
        nodes, opened = [F.array(pair["x"], pair["y"])[k] for k in (0, 1)], [pair["p"], pair["q"]]
        shared = F.lit(0)
        for n, o in zip(nodes, opened):
            shared = shared + _length(_leaves(n)) - _length(o)
        shared = shared + 2 * _length(F.array_intersect(*opened))
        rest = _length(F.array_except(*opened)) + _length(F.array_except(*reversed(opened)))
        # As the roots differ, at least a character does.
        return shared / (shared + rest + 1)

    x, y = a["nodes"], b["nodes"]
    pair = F.struct(x.alias("x"), y.alias("y"), _opened(x, y).alias("p"), _opened(y, x).alias("q"))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.transform(F.array(pair), met)[0])


def edit_span(a: Column, b: Column) -> Column:
    """Where b differs from a, in characters of b: ``start`` and ``end`` (exclusive), null if the roots are equal.

    What lies before and behind the span are the paragraphs both trees begin and end with; equal
    sections at both ends are passed over as wholes.
    """
    def common(x: Column, y: Column, most: Column) -> Column:
        """How many elements two arrays begin with in common, at most so many."""
        unequal = F.array_position(F.zip_with(F.slice(x, 1, most), F.slice(y, 1, most), lambda p, q: p == q), F.lit(False))
        return F.when(unequal > 0, unequal - 1).otherwise(most).cast("int")

    def within(x: Column, y: Column) -> Column:
        least = F.least(F.size(x), F.size(y))
        head = common(x, y, least)
        tail = common(F.reverse(x), F.reverse(y), least - head)
        before = _length(F.slice(y, 1, head))
        return F.struct(before.alias("start"), (_length(y) - _length(F.slice(F.reverse(y), 1, tail))).alias("end"))

    def span(pair: Column) -> Column:
        x, y = pair[0], pair[1]
        digests = [F.transform(n, lambda s: s["digest"]) for n in (x, y)]
        least = F.least(F.size(x), F.size(y))
        head = common(*digests, least)
        tail = common(F.reverse(digests[0]), F.reverse(digests[1]), least - head)
        middle = [F.slice(n, head + 1, F.size(n) - head - tail) for n in (x, y)]
        before = _length(_leaves(F.slice(y, 1, head)))
        inner = F.transform(F.array(F.array(*[_leaves(m) for m in middle])), lambda m: within(m[0], m[1]))[0]
        return F.struct((before + inner["start"]).alias("start"), (before + inner["end"]).alias("end"))

    return F.when(a["root"] != b["root"], F.transform(F.array(F.array(a["nodes"], b["nodes"])), span)[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "tree") -> DataFrame:
    """The documents with their Merkle tree under ``name``. Narrow; all other columns stay.

    A name the table already has is refused. Null texts are as empty ones; repeated rows each
    have their tree; texts of any length are split whole.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {name}")
    return docs.withColumn(name, merkle_tree(F.col(text)))


def with_next_text(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SPAN_ROWS, most: int = MOST_SPANS) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their tree and the text and tree of the next one by descending key; the dict names these columns.

    Null keys come last, rows of one key in order of their texts' hash, and the last document is
    followed by the first; a single document follows itself. Equal rows are documents of their
    own, one behind the other.

    The order is cut into spans of about ``rows`` documents, ``most`` spans at most, at documents
    that a hash picks. Their order values, a bounded list, go to all tasks, which look up the span
    of a row by bisection; every row moves once, to its span, and the first row of a span to the one
    before it too. Equal rows share a span.
    """
    names = dict(zip(("tree", "next_text", "next_tree"), fresh(docs, "tree", "next_text", "next_tree")))
    order, span, guest, bounds = fresh(docs, "order", "span", "guest", "bounds")
    t, k = F.coalesce(F.col(text), F.lit("")), F.col(key).cast("bigint")
    place = F.struct(
        k.isNull().cast("int").alias("last"), F.bitwise_not(F.coalesce(k, F.lit(0).cast("bigint"))).alias("down"),
        F.xxhash64(t).alias("hash"), F.length(t).alias("size"),
    )
    placed = docs.select("*", place.alias(order))
    n = docs.count()
    step = max(rows, -(-n // most))
    picked = F.when(F.pmod(F.xxhash64(order), F.lit(step)) == 0, F.col(order))
    first = F.array(F.min(order))
    cuts = placed.agg(F.sort_array(F.array_distinct(F.concat(F.collect_set(picked), first))).alias("b")).scalar()
    # Bisection: powers of two are added to the number of bounds passed as long as the row is not before the next.
    powers = F.lit([1 << p for p in reversed(range(max(1, n).bit_length()))])

    def passed(lo: Column, p: Column) -> Column:
        there = F.when(lo + p <= F.size(bounds), F.get(F.col(bounds), lo + p - 1) <= F.col(order))
        return F.when(there, lo + p).otherwise(lo)

    found = placed.select("*", cuts.alias(bounds)).select("*", F.aggregate(powers.cast("array<int>"), F.lit(0), passed).alias(span))
    before = F.when(F.col(span) > 1, F.col(span) - 1).otherwise(F.size(bounds))
    is_first = F.get(F.col(bounds), F.col(span) - 1) == F.col(order)
    places = F.array(F.struct(F.col(span).alias("s"), F.lit(0).alias("g")))
    places = F.when(is_first, F.concat(places, F.array(F.struct(before.alias("s"), F.lit(1).alias("g"))))).otherwise(places)
    sent = found.select(*docs.columns, order, F.inline(places).alias(span, guest))
    sent = sent.repartition(F.col(span)).select("*", merkle_tree(F.col(text)).alias(names["tree"]))
    along = Window.partitionBy(span).orderBy(guest, order)
    met = sent.select("*", F.lead(t).over(along).alias(names["next_text"]), F.lead(names["tree"]).over(along).alias(names["next_tree"]))
    return met.where(F.col(guest) == 0).drop(order, span, guest), names


def edited(text: Column, other: Column) -> Column:
    """The text with its last half exchanged for the beginning of the other text, as long or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(other, F.lit(1), half))


@query()
def op13_fingerprints(spark, sf_dir):
    docs, names = with_next_text(table(spark, sf_dir, "documents", "doc_id", "text"))
    own, other = F.col(names["tree"]), F.col(names["next_tree"])
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.length(text).cast("bigint").alias("n_chars"),
        own["root"].alias("fingerprint"), own.alias("own"), likeness(own, other).alias("near_next"),
        edited(text, F.col(names["next_text"])).alias("edited"),
    )
    rows = rows.select("*", F.sha2("edited", 256).alias("edited_sha256"), merkle_tree(F.col("edited")).alias("changed"))
    span = edit_span(F.col("own"), F.col("changed"))
    rows = rows.select("*", likeness(F.col("own"), F.col("changed")).alias("near_edited"), span.alias("edit"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", F.col("changed.root").alias("edited_fingerprint"), "near_edited", "near_next",
        F.col("edit.start").alias("edit_start"), F.col("edit.end").alias("edit_end"),
    )
