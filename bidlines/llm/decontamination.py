"""Benchmark decontamination over a positional inverted index of the training documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, cut_lineage, fresh, query, table, terms

WINDOW, SHARE = 13, 20
#: Terms of test items up to this size in all are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: What lies between words before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words as they stand, for ``terms`` without the cost of lower-casing whole texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def numbered_items(items: DataFrame) -> DataFrame:
    """(no, item_id, item) for every different id and words; ``item`` is the words, ``no`` a number of this frame.

    Repeated rows are one item; other words under the same id, or the same words under other ids,
    are items of their own, also where the id is null. Items without words are left out. The
    numbers hold once the frame is written.
    """
    w = items.select("item_id", terms(F.col("text")).alias("item")).where(F.size("item") > 0).distinct()
    return w.select(F.monotonically_increasing_id().alias("no"), "item_id", "item")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(no, item_id, item, at, len) for every window of every numbered item; ``at`` counts from 0."""
    n = F.least(F.size("item"), F.lit(window)).alias("len")
    return numbered_items(items).select("no", "item_id", "item", n).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("item") - F.col("len"))))


def _docs(docs: DataFrame, key: str, text: str) -> DataFrame:
    # A row is known by its key and its text, so rows that repeat both are one here.
    return docs.select(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), _words(F.col(text)).alias("w"))


def _looked_up(terms_of: DataFrame) -> DataFrame:
    """The frame of ``term`` rows, marked for broadcast if its measured size is under the bound; beyond it the join shuffles."""
    size = terms_of.agg(F.sum(F.octet_length("term") + 48)).first()[0] or 0
    return F.broadcast(terms_of) if size <= BROADCAST_BYTES else terms_of


def term_counts(docs: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): how often each of the terms stands in all documents, letters of either case taken as one."""
    tokens = docs.select(F.explode(_words(F.col(text))).alias("t")).select(F.lower("t").alias("coarse"))
    counts = tokens.join(vocabulary.select(F.lower("term").alias("coarse")).distinct(), "coarse").groupBy("coarse").agg(F.count("*").alias("n"))
    return vocabulary.join(counts, F.lower("term") == F.col("coarse")).select("term", "n")


def positional_index(docs: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (k, h, pos, term) of the terms, and one row of term '' for each document.

    ``pos`` is the word's place from 0; the row of term '' has the number of words as its place.
    The index is written once, and no posting carries its text.
    """
    # The row of a document is a word of its own that stands behind the others.
    tokens = _docs(docs, key, text).select("k", "h", F.posexplode(F.array_append("w", F.lit(""))).alias("pos", "t"))
    lookup = vocabulary.select("term").union(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    found = tokens.join(_looked_up(lookup.withColumn("coarse", F.lower("term"))), F.lower("t") == F.col("coarse")).where(ascii_lower(F.col("t")) == F.col("term"))
    return cut_lineage(found.select("k", "h", "pos", "term"))


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (k, h, n_words) and the occurrences (k, h, item_id, base, at, len) of item windows in them.

    Window ``at`` of an item stands at word ``base + at`` of the document. For each window its two
    rarest terms are looked up; their posting lists, each moved back by the term's place in the
    item, are intersected, and only where both agree are the words of the document compared exactly.
    """
    windows = cut_lineage(item_windows(items, window))
    vocabulary = cut_lineage(windows.select(F.explode("item").alias("term")).distinct())
    counts = cut_lineage(term_counts(docs, _looked_up(vocabulary), text))
    # Windows with a term that no document has drop out here: not all their places have a count.
    spots = windows.select("no", "at", "len", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("len") - 1)).alias("place"), "item")
    spots = spots.withColumn("term", F.element_at("item", F.col("place") + 1)).drop("item").join(counts, "term")
    rank = F.row_number().over(W.partitionBy("no", "at").orderBy("n", "place"))
    alive = F.count("*").over(W.partitionBy("no", "at"))
    ranked = spots.withColumn("rank", rank).withColumn("alive", alive).where("alive = len and rank <= 2")
    probes = cut_lineage(ranked.select("no", "at", "len", "place", "term", "rank"))

    index = positional_index(docs, probes.select("term").distinct(), key, text)
    n_words = index.where("term = ''").select("k", "h", F.col("pos").cast("bigint").alias("n_words"))
    places = probes.select("no", "place", "term").distinct()
    moved = index.join(places, "term").select("k", "h", "no", (F.col("pos") - F.col("place")).alias("base"), "place")
    aligned = moved.groupBy("k", "h", "no", "base").agg(F.collect_set("place").alias("places"))
    both = probes.groupBy("no", "at", "len").agg(F.max(F.when(F.col("rank") == 1, F.col("place"))).alias("p1"), F.max(F.when(F.col("rank") == 2, F.col("place"))).alias("p2"))
    plans = cut_lineage(both.groupBy("no").agg(F.collect_list(F.struct("at", "len", "p1", "p2")).alias("plans")))

    def agree(p: Column) -> Column:
        return (F.col("base") + p.at >= 0) & F.array_contains("places", p.p1) & (p.p2.isNull() | F.array_contains("places", p.p2))

    met = aligned.join(plans, "no").select("k", "h", "no", "base", F.explode(F.filter("plans", agree)).alias("o"))
    met = cut_lineage(met.select("k", "h", "no", "base", "o.at", "o.len", (F.col("base") + F.col("o.at")).alias("start")))
    # A text is split once, whatever the number of places to be compared in it.
    at = met.groupBy("k", "h").agg(F.collect_set(F.struct("start", "len")).alias("spans")).select(F.col("k").alias("_k"), F.col("h").alias("_h"), "spans")
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.col(text).alias("t"))
    # The same plan at every size: texts move once, to the places asked for in them.
    rows = rows.hint("merge").join(at, (F.col("h") == F.col("_h")) & F.col("k").eqNullSafe(F.col("_k")))
    cut = F.transform(
        F.array(F.struct(terms(F.col("t")).alias("w"), F.col("spans").alias("s"))),
        lambda d: F.transform(d.s, lambda x: F.struct(x.start.alias("start"), x.len.alias("len"), F.slice(d.w, x.start + 1, x.len).alias("words"))),
    )
    stands = rows.select("k", "h", F.explode(F.flatten(cut)).alias("x")).select(F.col("k").alias("_k"), F.col("h").alias("_h"), F.col("x.start").alias("_start"), F.col("x.len").alias("_len"), "x.words").distinct()
    same = (F.col("h") == F.col("_h")) & F.col("k").eqNullSafe(F.col("_k")) & (F.col("start") == F.col("_start")) & (F.col("len") == F.col("_len"))
    phrases = windows.select("no", "item_id", "at", F.slice("item", F.col("at") + 1, F.col("len")).alias("phrase"))
    hits = met.join(stands, same).join(phrases, ["no", "at"]).where("words = phrase")
    return n_words, cut_lineage(hits.select("k", "h", "item_id", "base", "at", "len"))


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, h, item_id, first, last): stretches that hold an item's two rarest terms in order, at most ``slack`` words off their distance."""
    w = cut_lineage(numbered_items(items).where(F.size("item") > 1))
    vocabulary = cut_lineage(w.select(F.explode("item").alias("term")).distinct())
    spots = w.select("no", "item_id", F.posexplode("item").alias("place", "term")).join(term_counts(docs, vocabulary, text), "term")
    spots = spots.withColumn("rank", F.row_number().over(W.partitionBy("no").orderBy("n", "place"))).where("rank <= 2")
    pair = spots.groupBy("no", "item_id").agg(F.min(F.struct("place", "term")).alias("a"), F.max(F.struct("place", "term")).alias("b")).where("a.place < b.place")
    index = positional_index(docs, spots.select("term").distinct(), key, text)
    one = pair.join(index, F.col("a.term") == F.col("term")).select("k", "h", "item_id", "a", "b", F.col("pos").alias("first"))
    two = index.select(F.col("k").alias("k2"), F.col("h").alias("h2"), F.col("pos").alias("last"), F.col("term").alias("t2"))
    close = F.abs(F.col("last") - F.col("first") - (F.col("b.place") - F.col("a.place"))) <= slack
    met = one.join(two, F.col("k").eqNullSafe(F.col("k2")) & (F.col("h") == F.col("h2")) & (F.col("b.term") == F.col("t2")) & close & (F.col("last") > F.col("first")))
    return met.select("k", "h", "item_id", "first", "last").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (k, h, n_words, n_hit, item_ids, contaminated) for each document, k being its key and h the hash of its text.

    A word inside an occurrence of a window is hit; a document is contaminated if it has hit words
    and they are at least 1 in ``share``. Null texts have no words, items without words hit
    nothing, repeated rows stay, empty tables give no hits or no rows. Repeated rows of ``items``
    are one item, all texts of an id count, and a null id is an id like others, listed last. Text in
    ``items`` and documents is compared with A-Z lower-cased.
    """
    n_words, found = phrase_matches(docs, items, window, key, text)
    at = F.col("base") + F.col("at")
    covered = found.select("k", "h", F.explode(F.sequence(at, at + F.col("len") - 1)).alias("p")).distinct().groupBy("k", "h").agg(F.count("*").alias("n_hit"))
    # In a struct, as lists leave nulls out.
    listed = F.array_sort(F.transform(F.collect_list(F.struct("item_id")), lambda x: x["item_id"]))
    ids = found.select("k", "h", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("k", "h").agg(listed.alias("item_ids"))
    hit = covered.join(ids, (covered["h"] == ids["h"]) & covered["k"].eqNullSafe(ids["k"])).select(covered["k"].alias("hk"), covered["h"].alias("hh"), "n_hit", "item_ids")
    whole = n_words
    out = whole.join(hit, (F.col("h") == F.col("hh")) & F.col("k").eqNullSafe(F.col("hk")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select("k", "h", "n_words", n_hit.alias("n_hit"), item_ids.alias("item_ids"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


_SQL = rf"""
WITH d AS (SELECT doc_id, w, i FROM (SELECT doc_id, w, unnest(w) AS _, generate_subscripts(w, 1) AS i FROM
        (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents))),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS p
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW} + 1, 1))) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT DISTINCT d.doc_id, v.item_id, d.i, v.n FROM (SELECT DISTINCT n FROM v) AS ns
      JOIN d ON d.i + ns.n - 1 <= len(d.w) JOIN v ON v.n = ns.n AND v.p = array_to_string(d.w[d.i : d.i + ns.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM o) GROUP BY doc_id),
n AS (SELECT doc_id, len(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n_words FROM documents)
SELECT n.doc_id, n_words::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= n_words AS contaminated
FROM n LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query(_SQL)
def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    ids = F.array_join("item_ids", ",")
    return out.select(F.col("k").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated; all columns are kept, repeated rows stay."""
    (h,) = fresh(docs, "h")
    bad = decontaminate(docs, items, key=key, text=text).where("contaminated").select(F.col("k").alias("_bad_k"), F.col("h").alias("_bad_h"))
    mine = docs.withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return mine.join(bad, (F.col(h) == F.col("_bad_h")) & F.col(key).eqNullSafe(F.col("_bad_k")), "left_anti").select(*docs.columns)
