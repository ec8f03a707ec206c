"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, query, table

#: Fixed patterns by kind, the group that must be long enough, and its least length.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: What the models judge; the log-likelihood ratio (in nats) from which it counts as random.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
RATIO = 12.0
#: Bounds of the labelled samples: texts for ordinary identifiers, strings of each random kind.
SAMPLE_TEXTS, SAMPLE_STRINGS = 1000, 2000
_CODES = 128


def _found(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans (start, end, hit) of the matches, in code points, end exclusive; those with a short group left out.

    What lies between matches comes from a split by the same pattern, so the lengths add up to places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), part.alias("part"))
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        keep = F.length(x["part"]) >= least
        span = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.when(keep, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(zipped, start, step, lambda acc: acc["spans"])
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(none)


def _pairs(strings: DataFrame) -> dict[tuple[int, int], int]:
    """How often each pair of neighbouring ASCII characters stands in the column ``s``; as many rows as pairs at most."""
    pairs = strings.select(F.explode(F.regexp_extract_all("s", F.lit("(?s)(?=(..))"), F.lit(1))).alias("p"))
    counts = pairs.groupBy("p").count().collect()
    return {(ord(r["p"][0]), ord(r["p"][1])): r["count"] for r in counts if r["p"].isascii() and len(r["p"]) == 2}


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled samples of random strings: base64, its web form, hexadecimal and capital keys."""
    raw = F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256))
    code = F.base64(raw)
    kinds = F.array(code, F.translate(code, "+/=", "-_"), F.lower(F.hex(raw)), F.concat(F.lit("AKIA"), F.regexp_replace(F.upper(code), "[^A-Z0-9]", "")))
    return spark.range(n).select(F.explode(kinds).alias("s"))


def ordinary_strings(docs: DataFrame, text: str = "text", n: int = SAMPLE_TEXTS) -> DataFrame:
    """Labelled samples of ordinary identifiers: the words of a bounded sample of texts, alone and joined as names are."""
    sample = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), F.col(text).alias("t")).orderBy("h", "t").limit(n)
    for pattern, _, _ in PATTERNS.values():
        sample = sample.withColumn("t", F.regexp_replace("t", pattern, " "))
    words = F.filter(F.split("t", r"[^A-Za-z]+"), lambda w: F.length(w) > 1)
    names = sample.select(words.alias("w")).select(F.explode(F.array(F.array_join("w", "_"), F.array_join("w", "-"), F.array_join(F.transform("w", F.initcap), ""))).alias("s"))
    names = names.unionByName(docs.sparkSession.range(1).select(F.lit("get_user_name_by_id_2024 http_server-01 maxRetryCount utf-8 src/main/java/index/2023/12").alias("s")))
    return names.select(F.explode(F.split("s", " ")).alias("s"))


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of characters (first * 128 + second)."""
    models = [_pairs(random_strings(docs.sparkSession)), _pairs(ordinary_strings(docs, text))]
    out = []
    totals = [[sum(n for (a, _), n in m.items() if a == c) for c in range(_CODES)] for m in models]
    for a in range(_CODES):
        for b in range(_CODES):
            r, o = (math.log((m.get((a, b), 0) + 0.5) / (t[a] + 0.5 * 66)) for m, t in zip(models, totals))
            out.append(r - o)
    return out


def _ratio(s: Column, ratios: Column) -> Column:
    def add(acc: Column, c: Column) -> Column:
        pair = F.element_at(ratios, acc["last"] * _CODES + F.ascii(c) + 1)
        return F.struct(F.ascii(c).alias("last"), (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(pair)).alias("sum"))

    return F.aggregate(F.split(s, ""), F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), add, lambda acc: acc["sum"])


def scan_secrets(docs: DataFrame, ratios: list[float], text: str = "text", name: str = "secrets") -> DataFrame:
    """The documents with their secrets: an array of (start, kind, end) in the order of start and kind.

    The kinds are those of PATTERNS, in their order, and then ``random``: a run of key characters,
    inside no other span, that the Markov model of random strings makes likelier than that of
    ordinary identifiers by RATIO or more. One narrow pass, all in the JVM; a text is never shortened.
    Null texts are empty; repeated rows stay; an empty table gives an empty one.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bounded = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    kinds = list(PATTERNS)
    span = "array<struct<start:int,kind:int,end:int,score:double>>"

    def of_kind(i: int, k: str) -> Column:
        return F.transform(_found(t, *PATTERNS[k]), lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("score")))

    base = F.flatten(F.array(*[of_kind(i, k) for i, k in enumerate(kinds)]))
    own, more = fresh(docs, "own", "more")
    kept = docs.select("*", base.cast(span).alias(own), _found(t, CANDIDATE, 0, 16).alias(more))
    beside = F.filter(more, lambda m: ~F.exists(own, lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    judged = F.transform(beside, lambda m: F.struct(m["start"].alias("start"), F.lit(len(kinds)).alias("kind"), m["end"].alias("end"), _ratio(m["hit"], bounded).alias("score")))
    random = F.filter(judged, lambda m: m["score"] >= RATIO)
    return kept.select(*docs.columns, F.array_sort(F.concat(own, random.cast(span))).alias(name))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*PATTERNS, "random")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op5_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan_secrets(docs, train(docs))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"] < len(PATTERNS))
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(PATTERNS)], F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("secrets")).alias("spans"))
