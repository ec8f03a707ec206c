"""Line dedup: an exact set-similarity join of lines, with prefix, positional and length filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, discard, fresh, query, table

SIMILAR = 0.8
#: Counters of token frequency: a token's rarity is that of its counter. Their number is fixed.
COUNTERS = 1 << 18
#: A word whose counter is above this may stand in a large group of like lines, which is not met in pairs.
FREQUENT = 512
#: Sets of so many words have a parity code of 128 bits, smaller ones one of 64.
LARGE = 72
_HASH_BITS = 56
#: Size of the hash table in which a task counts first. At Spark's own size most counters miss it.
_FAST_MAP = "spark.sql.codegen.aggregate.fastHashMap.capacityBit"


def _blank(line: Column) -> Column:
    return F.trim(line) == ""


def _level(count: Column) -> Column:
    return F.least(F.lit(127), (4 * F.log2(1 + count)).cast("int"))


def token_levels(docs: DataFrame, text: str = "text") -> str:
    """Rarity of each counter, comma-joined, by the different tokens of each document: quarters of the count's binary logarithm, 127 at most."""
    spark = docs.sparkSession
    tokens = docs.select(F.explode(_hashes(F.col(text), "[ \n]")).alias("t"))
    counted = tokens.groupBy(_counter(F.col("t")).alias("c")).count()
    every = spark.range(COUNTERS).select(F.col("id").cast("int").alias("c")).join(counted, "c", "left")
    levels = every.select(F.struct("c", _level(F.coalesce("count", F.lit(0))).alias("level")).alias("x"))
    # One string: the driver holds no row per counter.
    joined = levels.agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["level"].cast("string")), ","))
    before = spark.conf.get(_FAST_MAP, None)
    spark.conf.set(_FAST_MAP, str(COUNTERS.bit_length()))
    try:
        return joined.first()[0]
    finally:
        spark.conf.unset(_FAST_MAP) if before is None else spark.conf.set(_FAST_MAP, before)


def _counter(h: Column) -> Column:
    return h.bitwiseAND(COUNTERS - 1).cast("int")


def _hashes(line: Column, gap: str = " ") -> Column:
    """Different tokens as numbers."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, gap), lambda t: F.xxhash64(t))), F.xxhash64(F.lit("")))


def _keys(line: Column, levels: Column) -> Column:
    """Different tokens as numbers, the rarest first: the counter's level above 56 bits of the token's hash."""
    def key(h: Column) -> Column:
        return F.shiftleft(F.get(levels, h.bitwiseAND(COUNTERS - 1)), _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    return F.sort_array(F.transform(_hashes(line), key))


def _parity(keys: Column) -> Column:
    """64 bits, each the parity of the words that fall on it; sets that differ in d words differ in d bits at most."""
    return F.aggregate(keys, F.lit(0).cast("bigint"), lambda acc, k: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(63).cast("int"))))


def _half(keys: Column) -> Column:
    """The parity of one half of the words of a large set: with that of all it gives both halves, 128 bits."""
    return F.when(F.size(keys) >= LARGE, _parity(F.filter(keys, lambda k: k.bitwiseAND(64) != 0))).otherwise(F.lit(0).cast("bigint"))


def _apart(a: str, b: str) -> Column:
    """Bits in which the parity codes of two sets differ."""
    u = F.col(f"{a}.u").bitwiseXOR(F.col(f"{b}.u"))
    v = F.col(f"{a}.v").bitwiseXOR(F.col(f"{b}.v"))
    large = F.least(F.abs(F.col(f"{a}.n")), F.abs(F.col(f"{b}.n"))) >= LARGE
    return F.bit_count(F.when(large, u.bitwiseXOR(v)).otherwise(u)) + F.when(large, F.bit_count(v)).otherwise(0)


def _least_overlap(n: Column, m: Column, similar: float) -> Column:
    return F.ceil((n + m) * (similar / (1 + similar)) - 1e-9)


def kept_lines(docs: DataFrame, similar: float = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, h, kept): by document the numbers of its lines, from 0, that match no earlier line.

    Two lines match if their sets of words (between blanks) have a Jaccard similarity of
    ``similar`` or more; earlier means a smaller (key, hash of the text, line). Lines of the same
    set are one from the start, at their first place. Words are ordered by rarity over all
    documents; matching sets share a word among their rarest few (prefix), differ little in size
    (length), have enough words left behind the shared one (position), and differ in few bits of a
    parity code of their words, which can never be more than the words they differ in. Each set is first
    compared with the earliest one of each of its rare words that are frequent. Where these make groups of
    many, only sets without a match there look for one among all sets, so that a large group of like lines
    does not meet in pairs. Every candidate is verified on the whole sets.
    """
    levels = F.split(F.lit(token_levels(docs, text)), ",").cast("array<bigint>")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    # Texts in the order of places, so the numbers of their lines are in that order too.
    lines = rows.orderBy(F.col("k").isNull(), "k", "h").select("k", "h", F.posexplode(F.split("t", "\n")).alias("line", "l"))
    sets = lines.withColumn("id", F.monotonically_increasing_id()).where(~_blank(F.col("l"))).select("id", "k", "h", "line", _keys(F.col("l"), levels).alias("keys"))
    n = F.size("keys")
    reach = n - F.ceil(n * similar - 1e-9).cast("int") + 1
    known = [F.xxhash64("keys").alias("s"), n.alias("n"), _parity(F.col("keys")).alias("u"), _half(F.col("keys")).alias("v"), F.slice("keys", 1, reach).alias("prefix")]
    every = cut_lineage(sets.select("id", "k", "h", "line", *known))
    # A set is known by the number of its first line.
    first = cut_lineage(every.groupBy("s", "n", "u", "v", "prefix").agg(F.min("id").alias("id")).drop("s"))
    places = cut_lineage(every.select("id", "k", "h", "line"))
    discard(every)

    def spread(of: DataFrame) -> DataFrame:
        return of.select("id", "n", "u", "v", F.posexplode("prefix").alias("pos", "key"))

    def may(a: str, b: str) -> Column:
        # A size below 0 is that of a set known to match, which looks for no other.
        x, y = F.col(f"{a}.n"), F.abs(F.col(f"{b}.n"))
        left = F.least(x - F.col(f"{a}.pos"), y - F.col(f"{b}.pos"))
        least = _least_overlap(x, y, similar)
        return (F.col(f"{b}.id") < F.col(f"{a}.id")) & (F.least(x, y) >= F.greatest(x, y) * similar - 1e-9) & (_apart(a, b) <= x + y - 2 * least) & (left >= least)

    def frequent(key: Column) -> Column:
        return F.shiftrightunsigned(key, _HASH_BITS) > _level(F.lit(FREQUENT))

    pair = [F.col("a.id").alias("id"), F.col("b.id").alias("o")]
    # The last word of a prefix is its most frequent one.
    often = spread(first.where(frequent(F.element_at("prefix", -1)))).where(frequent(F.col("key")))
    head = often.groupBy("key").agg(F.min(F.struct("id", "n", "pos", "u", "v")).alias("e")).select("key", "e.*")
    one = cut_lineage(often.alias("a").hint("merge").join(head.alias("b"), "key").where(may("a", "b")).select(*pair).distinct())
    # As many pairs as the groups around the earliest ones would make; if fewer than sets, they do no harm.
    pairs = one.groupBy("o").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    asked = one if (pairs or 0) > first.count() else one.where("false")
    matched = _verified(rows, places, asked, similar) if asked is one else asked.select("id")
    known = first.join(matched.select("id", F.lit(True).alias("met")).hint("merge"), "id", "left")
    # Both sides of the join are the same rows, so they are moved and written once.
    words = spread(known.withColumn("n", F.when(F.col("met"), -F.col("n")).otherwise(F.col("n"))))
    two = words.alias("a").hint("merge").join(words.alias("b"), "key").where(may("a", "b")).select(*pair).distinct()
    two = cut_lineage(two.join(asked.select("id", "o"), ["id", "o"], "left_anti"))
    more = _verified(rows, places, two, similar)
    kept = cut_lineage(first.select("id").join(matched.unionByName(more), "id", "left_anti"))
    out = cut_lineage(places.select("id", "k", "h", "line").join(kept, "id").groupBy("k", "h").agg(F.collect_set("line").alias("kept")))
    for read in (first, places, one, matched, two, more, kept):
        discard(read)
    return out


def _verified(rows: DataFrame, places: DataFrame, pairs: DataFrame, similar: float) -> DataFrame:
    """Sets ``id`` of the candidate pairs (id, o) that are as similar as asked, by their whole words.

    A set needs one match only: the last of its candidates is tested first, and the others
    only where that one fails, so that whole sets do not travel with every pair.
    """
    wanted = places.select("id", "k", "h", "line").join(pairs.select("id").union(pairs.select("o")).distinct(), "id")
    of = wanted.groupBy("k", "h").agg(F.collect_list(F.struct("id", "line")).alias("lines")).select(F.col("k").alias("_k"), F.col("h").alias("_h"), "lines")
    # Rows that repeat key and text are one document here.
    texts = rows.join(of.hint("shuffle_hash"), (F.col("h") == F.col("_h")) & F.col("k").eqNullSafe(F.col("_k")))
    each = texts.select(F.split("t", "\n").alias("all"), F.explode("lines").alias("x")).select("x.id", F.element_at("all", F.col("x.line") + 1).alias("l"))
    whole = cut_lineage(each.select("id", _hashes(F.col("l")).alias("keys")).dropDuplicates(["id"]))
    # The last candidates of a group of like lines differ, the first is the same for all: no key is hot.
    begun = cut_lineage(_alike(pairs.groupBy("id").agg(F.max("o").alias("o")), whole, similar))
    rest = pairs.join(begun.hint("merge"), "id", "left_anti")
    found = cut_lineage(begun.unionByName(_alike(rest, whole, similar).distinct()))
    for read in (whole, begun):
        discard(read)
    return found


def _alike(pairs: DataFrame, whole: DataFrame, similar: float) -> DataFrame:
    """``id`` of each pair (id, o) whose sets in ``whole`` (id, keys) are as similar as asked."""
    left, right = whole.withColumnRenamed("keys", "x"), whole.select(F.col("id").alias("o"), F.col("keys").alias("y"))
    both = pairs.join(left, "id").join(right, "o")
    return both.where(F.size(F.array_intersect("x", "y")) >= _least_overlap(F.size("x"), F.size("y"), similar)).select("id")


def dedup_lines(docs: DataFrame, similar: float = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that match an earlier line; documents that have no word left go.

    Blank lines stay where they are. Null texts and texts without words stay as they are. Rows that
    repeat both key and text are one document and keep the same lines; null keys come last; columns
    keep their names; an empty table gives an empty one.
    """
    lines, left = lined(docs, similar, key, text)
    rebuilt = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda l, i: _blank(l) | F.array_contains(left, i)), "\n")
    gone = (F.size(left) == 0) & F.rlike(F.col(text), F.lit("[^ \n]"))
    return lines.where(~F.coalesce(gone, F.lit(False))).select(*[rebuilt.alias(c) if c == text else F.col(c) for c in docs.columns])


def lined(docs: DataFrame, similar: float, key: str, text: str) -> tuple[DataFrame, Column]:
    """The documents joined with the numbers of the lines they keep, and the column of these."""
    h, of_k, of_h, numbers = fresh(docs, "h", "of_k", "of_h", "numbers")
    kept = kept_lines(docs, similar, key, text).toDF(of_k, of_h, numbers)
    out = docs.withColumn(h, F.xxhash64(text)).join(kept, (F.col(h) == F.col(of_h)) & F.col(key).eqNullSafe(F.col(of_k)), "left")
    return out, F.coalesce(numbers, F.array().cast("array<int>"))


@query()
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    kept = kept_lines(docs).select(F.col("k").alias("_k"), F.col("h").alias("_h"), "kept")
    numbers = F.filter(F.transform(F.split("text", "\n"), lambda l, i: F.when(~_blank(l), i)), lambda i: i.isNotNull())
    mine = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(numbers, F.array().cast("array<int>")).alias("lines"))
    out = mine.join(kept, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_k")), "left")
    removed = F.array_except("lines", F.coalesce("kept", F.array().cast("array<int>")))
    return out.select("doc_id", F.size("lines").cast("bigint").alias("n_lines"), F.size(removed).cast("bigint").alias("n_removed"), F.array_join(removed, ",").alias("removed"))
