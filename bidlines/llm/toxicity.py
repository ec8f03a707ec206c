"""Toxicity: a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

The machine sees spans of sentences: runs of up to RUN words, the blanks between them being letters
that a subsequence may hold or skip. A text scores as its most toxic span.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, query, table

#: Letters of a subsequence, letters it may skip in all, what each skipped letter costs, words of a span.
LENGTH, SKIP, DECAY, RUN = 4, 2, 0.5, 4
#: Bounds of what the model is fitted on: labelled texts, spans taken from one of them, clean spans, landmarks; rounds.
MAX_TEXTS, TEXT_SPANS, CLEAN_SPANS, LANDMARKS, ROUNDS = 20_000, 64, 6000, 256, 3
#: A span of a toxic text is a witness where it scores over what this share of clean texts reach.
WITNESS = 0.85
#: Weight of the disguised forms of a witness against its own in the fit; of all of them against the toxic texts on the scale.
DISGUISED, PROBES = 1.0, 0.25
#: Letters of a gram and counters of grams, by which the first witnesses are found.
GRAM, COUNTERS = 5, 1 << 20
#: Characters and texts worked on at once; a longer text is taken in pieces that share RUN - 1 words.
CHARS_AT_ONCE, TEXTS_AT_ONCE = 300_000, 500
#: Characters that stand for letters in disguised words, and marks that are left out (fixed by habit of writing).
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
MARKS = ".,;:?\"'()[]{}<>#&%|/\\-_*"
#: Classes of characters: left out, blank, a-z, the rest folded into a fixed number. Score of a text without words.
CLASSES, WORDLESS = 40, -2.0
_EDGE, _REST = 1, 28
PATTERNS = [p for p in combinations(range(LENGTH + SKIP), LENGTH) if p[0] == 0]
LASTS = range(LENGTH - 1, LENGTH + SKIP)
_SPACED = re.compile(r"(?<!\S)(?:\w[.\-_*]? ){2,}\w(?!\w)")
_INSERTED = "x e q h a n z l y o "


def _class_table() -> np.ndarray:
    points = np.arange(0x3000)
    out = _REST + points % (CLASSES - _REST)
    out[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    for mark, letter in DISGUISE.items():
        out[ord(mark)] = 2 + ord(letter) - ord("a")
    out[[ord(m) for m in MARKS]] = 0
    out[[p for p in range(len(out)) if chr(p).isspace() or p == 0]] = _EDGE
    return out


_CLASS = _class_table()


class Letters:
    """The letters of some texts: ``cls`` one class a letter, word k between the blanks ``edges[k]`` and
    ``edges[k + 1]``, with the number of its sentence and of its text. Single letters in a row are one word."""

    def __init__(self, texts: list[str]):
        plain = (_SPACED.sub(lambda m: re.sub(r"[\s.\-_*]", "", m[0]), t.replace("\0", " ").lower()) for t in texts)
        points = np.frombuffer(("\0" + "\0".join(plain) + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
        cls = np.where(points < len(_CLASS), _CLASS[np.minimum(points, len(_CLASS) - 1)], _REST + points % (CLASSES - _REST))
        before_blank = np.r_[cls[1:] == _EDGE, True]
        # An exclamation mark stands for a letter only where a letter follows in the same word.
        solid = np.flatnonzero((cls > 0) & (points != ord("!")))
        bang = np.flatnonzero(points == ord("!"))
        cls[bang[cls[solid[np.searchsorted(solid, bang)]] == _EDGE]] = 0
        stop = (points == ord("\n")) | (points == 0) | (np.isin(points, [ord(c) for c in ".?!"]) & before_blank)
        sentence, text = np.cumsum(stop), np.cumsum(points == 0) - 1
        kept = np.flatnonzero(cls > 0)
        blank = cls[kept] == _EDGE
        kept = kept[~(blank & np.r_[False, blank[:-1]])]
        self.points, self.cls = points[kept], cls[kept]
        self.edges = np.flatnonzero(self.cls == _EDGE)
        words = kept[self.edges[:-1] + 1]
        self.sentence, self.text = sentence[words], text[words]

    def codes(self, pattern) -> np.ndarray:
        """Number of the subsequence at each place where the pattern has room."""
        n = max(len(self.cls) - pattern[-1], 0)
        code = np.zeros(n, np.int64)
        for p in pattern:
            code = code * CLASSES + self.cls[p : p + n]
        return code

    def spans(self, sums: dict[int, np.ndarray], constant: float):
        """(first word, number of words, score) of every span; ``sums`` holds running sums of weights by the
        distance of the last letter of a subsequence from its first."""
        firsts, runs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for n in range(1, min(RUN, len(self.sentence)) + 1):
            first = np.arange(len(self.sentence) - n + 1)
            first = first[self.sentence[first] == self.sentence[first + n - 1]]
            start, end = self.edges[first], self.edges[first + n]
            total = np.zeros(len(first))
            for last, c in sums.items():
                total += c[np.clip(end - last + 1, np.minimum(start, len(c) - 1), len(c) - 1)] - c[np.minimum(start, len(c) - 1)]
            firsts.append(first), runs.append(np.full(len(first), n))
            scores.append(total / np.sqrt(size_of(end - start + 1)) + constant)
        return np.concatenate(firsts), np.concatenate(runs), np.concatenate(scores)

    def span(self, first: int, n: int) -> str:
        return "".join(" " if c == _EDGE else chr(p) for p, c in zip(*(x[self.edges[first] + 1 : self.edges[first + n]].tolist() for x in (self.points, self.cls))))


def size_of(n: np.ndarray) -> np.ndarray:
    """Squared weights of all subsequences of a span of n letters, by which spans of all lengths are made alike."""
    return np.maximum(sum(DECAY ** (2 * (p[-1] + 1 - LENGTH)) * np.maximum(n - p[-1], 0) for p in PATTERNS), 1.0)


def subsequences(spans: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(span number, code, weight) of every subsequence of LENGTH letters with SKIP letters skipped at most, scaled by the span's size."""
    one = Letters(["\n".join(spans)])
    bounds = one.edges[np.r_[np.flatnonzero(np.r_[True, one.sentence[1:] != one.sentence[:-1]]), len(one.sentence)]]
    here = np.arange(len(one.cls))
    rows, codes, weights = [], [], []
    for pattern in PATTERNS:
        code = one.codes(pattern)
        # A blank ends one span and begins the next.
        owner = np.searchsorted(bounds, here[: len(code)], "right") - 1
        inside = np.flatnonzero((owner < len(spans)) & (here[: len(code)] + pattern[-1] <= bounds[np.minimum(owner + 1, len(bounds) - 1)]))
        rows.append(owner[inside]), codes.append(code[inside])
        weights.append(np.full(len(inside), DECAY ** (pattern[-1] + 1 - LENGTH)))
    row = np.concatenate(rows)
    return row, np.concatenate(codes), np.concatenate(weights) / np.sqrt(size_of(np.diff(bounds) + 1))[row]


def kernel(spans: list[str], landmarks: list[str]) -> np.ndarray:
    """Subsequence kernel of spans with landmarks (spans in lower case, words apart by one blank, none without letters)."""
    out = np.zeros((len(spans), len(landmarks)))
    r, c, w = subsequences(spans)
    lr, lc, lw = subsequences(landmarks)
    dense = np.zeros(CLASSES**LENGTH)
    for k in range(len(landmarks)):
        mine = lr == k
        np.add.at(dense, lc[mine], lw[mine])
        out[:, k] = np.bincount(r, w * dense[c], minlength=len(spans))
        dense[lc[mine]] = 0
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last coefficient is the constant."""
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        m = 1 - y * (x @ beta)
        act = m > 0
        xa = x[act] * weight[act, None]
        grad = penalty * np.r_[beta[:-1], 0] - xa.T @ (y[act] * m[act])
        hess = xa.T @ x[act] + penalty * np.diag(np.r_[np.ones(len(beta) - 1), 1e-6])
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _disguised(span: str) -> list[str]:
    """The span with one letter or blank put in, at each place."""
    return [f"{span[:k]}{_INSERTED[k % len(_INSERTED)]}{span[k:]}" for k in range(1, min(len(span), 16))]


def train(texts: DataFrame, label: str = "toxic", text: str = "text") -> dict:
    """A model from labelled texts, as many as one wants to fit it on (``labelled`` gives MAX_TEXTS at most).

    A label holds for a text, but one span may earn it, so the machine is fitted in rounds. Examples for
    are the witnesses of toxic texts, spans that score over what most clean texts reach, and the same with
    one letter or blank put in; examples against are the highest spans of clean texts. The first witnesses
    come from letter grams that stand in more toxic texts than chance explains, the later ones from the
    machine itself. It is fitted on Nyström features of the kernel with landmarks from both sides and folded
    into one weight for each subsequence, so scoring a span is a sum of weights. The highest span of a text is put on
    the scale of probabilities by the labelled texts. Null labels and texts are left out, equal texts
    count once and as toxic where any of them is.
    """
    known = texts.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sample = cut_lineage(known.groupBy(F.xxhash64(text).alias("h"), F.col(text).alias("t")).agg(F.max(F.col(label).cast("int")).alias("y")).select("y", "t"))
    n, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return {"constant": float(n_toxic and 1)}
    base = n_toxic / n
    # How far the share of toxic texts lies above the usual one, in standard deviations.
    z = (F.col("p") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    grams = sample.mapInArrow(_gram_counts, "g int, p long, n long").groupBy("g").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    loud = grams.withColumn("z", z).where(f"p >= 2 and p > 0.5 * n and z >= {max(4.0, 2 * ((1 - base) / base) ** 0.5)}").select("g", "z").toPandas()
    model = {"grams": np.bincount(loud["g"], loud["z"], minlength=COUNTERS).astype(np.float32), "constant": 0.0}
    against: dict[str, tuple[float, int]] = {}
    for _ in range(ROUNDS):
        found = sample.mapInArrow(_examples(model), "y int, top double, span string, score double").toPandas()
        level = max(0.0, found[(found.y == 0) & found.span.isna()].top.quantile(WITNESS))
        witness = found[(found.y == 1) & (found.score > level)].groupby("span").size().sort_index().sort_values(ascending=False, kind="stable")
        clean = found[(found.y == 0) & found.span.notna()].groupby("span").score.agg(["max", "size"])
        against |= {s: (score, max(int(size), against.get(s, (0, 0))[1])) for s, score, size in clean.itertuples()}
        hard = sorted(sorted(against, key=lambda s: (-against[s][0], s))[:CLEAN_SPANS], key=lambda s: (-against[s][1], s))
        if witness.empty or not hard:
            return {"constant": base}
        model, disguised = _fit(list(witness.items()), [(s, against[s][1]) for s in hard])
    found = sample.mapInArrow(_tops(model), "y int, top double").toPandas()
    extra = spans_tops(disguised, model)
    tops = np.r_[found["top"], extra]
    weight = np.r_[np.ones(n), np.full(len(extra), n_toxic * PROBES / max(len(extra), 1))]
    return model | dict(zip("ab", _scale(tops, np.r_[found["y"], np.ones(len(extra))], weight)))


def _fit(witness: list[tuple[str, int]], hard: list[tuple[str, int]]) -> tuple[dict, list[str]]:
    """The machine folded into one weight a subsequence, and the disguised witnesses."""
    extra = [(v, DISGUISED * n / len(vs)) for s, n in witness if n > 1 for vs in [_disguised(s)] for v in vs]
    spans = [s for s, _ in witness + extra + hard]
    y = np.r_[np.ones(len(witness) + len(extra)), -np.ones(len(hard))]
    weight = np.sqrt(np.array([n for _, n in witness + extra + hard], float))
    weight[y > 0] *= weight[y < 0].sum() / weight[y > 0].sum()
    weight /= weight.mean()
    marks = [s for s, _ in witness[: LANDMARKS // 2]]
    marks += [s for s, _ in hard[: LANDMARKS - len(marks)]]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    beta = _svm(kernel(spans, marks) @ whiten, y, weight, 0.02 * len(y) ** 0.5)
    row, code, w = subsequences(marks)
    folded = np.bincount(code, w * (whiten @ beta[:-1])[row], minlength=CLASSES**LENGTH)
    return {"weights": folded.astype(np.float32), "constant": float(beta[-1])}, [v for v, _ in extra]


def _scale(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and constant: a half where fewest labels are wrong, as steep as the labels are likeliest."""
    order = np.argsort(x, kind="stable")
    x, y, weight = x[order], y[order], weight[order]
    wrong = np.r_[0, np.cumsum(weight * y)] + np.r_[np.cumsum((weight * (1 - y))[::-1])[::-1], 0]
    cuts, gaps = np.r_[x[0] - 1, (x[1:] + x[:-1]) / 2, x[-1] + 1], np.r_[1e-9, np.diff(x), 1e-9]
    wrong[gaps == 0] = np.inf
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    cut = cuts[best[np.argmax(gaps[best])]]
    far = np.clip(x - cut, -3, 3) * np.where(y > 0, 1, -1)
    slopes = np.geomspace(0.5, 16, 41)
    slope = slopes[np.argmin([(weight * np.logaddexp(0, -s * far)).sum() for s in slopes])]
    return float(slope), float(-slope * cut)


def _blocks(texts):
    """Lists of (text number, piece) of about CHARS_AT_ONCE characters; pieces of one text share RUN - 1 words."""
    block, size = [], 0
    for k, text in enumerate(texts):
        at = 0
        while True:
            end = at + CHARS_AT_ONCE
            if end < len(text):
                blank = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                end = blank if blank > at + CHARS_AT_ONCE // 2 else end
            block.append((k, text[at:end]))
            size += end - at if end < len(text) else len(text) - at
            if size >= CHARS_AT_ONCE:
                yield block
                block, size = [], 0
            if end >= len(text):
                break
            shared = text[max(at, end - 2000) : end].rsplit(None, RUN - 1)
            at = end - sum(len(s) + 1 for s in shared[1:])
    if block:
        yield block


def _sums(letters: Letters, model: dict) -> dict[int, np.ndarray]:
    if "grams" in model:
        return {GRAM - 1: np.r_[0, np.cumsum(model["grams"][_grams(letters)], dtype=float)]}
    out = {}
    for last in LASTS:
        total = sum(model["weights"][letters.codes(p)] for p in PATTERNS if p[-1] == last)
        out[last] = np.r_[0, np.cumsum(total * DECAY ** (last + 1 - LENGTH), dtype=float)]
    return out


def _grams(letters: Letters) -> np.ndarray:
    return letters.codes(range(GRAM)) * 0x9E3779B1 % (1 << 52) // (1 << 32) % COUNTERS


def spans_tops(texts: list[str], model: dict) -> np.ndarray:
    """Score of the most toxic span of each text, WORDLESS where a text has none."""
    top = np.full(len(texts), WORDLESS)
    for block in _blocks(texts):
        letters = Letters([piece for _, piece in block])
        first, _, score = letters.spans(_sums(letters, model), model["constant"])
        np.maximum.at(top, np.array([k for k, _ in block])[letters.text[first]], score)
    return top


def _gram_counts(batches):
    toxic, every = np.zeros(COUNTERS, np.int64), np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held = np.unique(np.concatenate([_grams(Letters([p for _, p in block])) for block in _blocks([text.as_py()])]))
            every[held] += 1
            toxic[held] += y
    code = np.flatnonzero(every)
    yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(toxic[code]), pa.array(every[code])], names=["g", "p", "n"])


def _examples(model):
    """Of a toxic text its spans over zero, best first and none across another, TEXT_SPANS at most; of a
    clean text the highest span of each number of words. One more row without a span has the highest score."""

    def of_text(y, text):
        top, found = WORDLESS, []
        for block in _blocks([text]):
            letters = Letters([piece for _, piece in block])
            first, run, score = letters.spans(_sums(letters, model), model["constant"])
            top = max(top, score.max(initial=WORDLESS))
            if y:
                used = np.zeros(len(letters.sentence), bool)
                over = np.flatnonzero(score > 0)
                for i in over[np.lexsort((run[over], -score[over]))]:
                    if not used[first[i] : first[i] + run[i]].any():
                        used[first[i] : first[i] + run[i]] = True
                        found.append((score[i], letters.span(first[i], run[i])))
            else:
                best = [np.flatnonzero(run == n) for n in range(1, RUN + 1)]
                found += [(score[i], letters.span(first[i], run[i])) for b in best if len(b) for i in [b[np.argmax(score[b])]]]
        return [(y, float(top), None, None)] + [(y, float(top), s, float(v)) for v, s in sorted(found, reverse=True)[:TEXT_SPANS]]

    def run(batches):
        for batch in batches:
            rows = [r for y, t in zip(batch.column(0).to_pylist(), batch.column(1)) for r in of_text(y, t.as_py())]
            kinds = [pa.int32(), pa.float64(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["y", "top", "span", "score"])

    return run


def _tops(model):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans_tops(batch.column(1).to_pylist(), model))], names=["y", "top"])

    return run


def _score_texts(model, name):
    def run(batches):
        for batch in (b.slice(k, TEXTS_AT_ONCE) for b in batches for k in range(0, b.num_rows, TEXTS_AT_ONCE)):
            top = spans_tops([t or "" for t in batch.column(0).to_pylist()], model)
            score = 1 / (1 + np.exp(-np.clip(model["a"] * top + model["b"], -30, 30)))
            yield pa.RecordBatch.from_arrays([pa.array(score), *batch.columns[1:]], names=[name, *batch.schema.names[1:]])

    return run


def score(docs: DataFrame, model: dict, text: str = "text", name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all, by default) with the score of the whole text, 0 to 1; narrow.

    Only the text is looked at. Null and empty texts score as texts without words; a very long text is
    taken in pieces that share words, so no span is lost but of words beyond CHARS_AT_ONCE letters; a
    model without examples of both labels gives every text the same score. Repeated rows stay and score alike; an
    empty table gives an empty one. Where a kept column has the name of the score in any case, the
    score's name gets underscores in front.
    """
    keep = docs.columns if keep is None else keep
    (name,) = fresh(docs.select(*keep), name)
    if "weights" not in model:
        return docs.select(*keep, F.lit(model["constant"]).alias(name))
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    raw = docs.select(F.coalesce(F.col(text), F.lit("")).alias(name), *keep)
    kept = "".join(f", `{c}` {types[c]}" for c in keep)
    return raw.mapInArrow(_score_texts(model, name), f"`{name}` double{kept}")


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def labelled(spark, sf_dir, max_texts: int = MAX_TEXTS) -> DataFrame:
    """Texts with labels that may be learned from: all, or a sample of ``max_texts`` labels by hash of the key."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(F.col("toxic").isNotNull() & ~held_out())
    sample = cut_lineage(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_texts))
    # As few rows as the sample has: the texts stay where they are.
    return table(spark, sf_dir, "documents", "doc_id", "text").join(F.broadcast(sample), "doc_id")


@query()
def op10_toxicity(spark, sf_dir):
    model = train(labelled(spark, sf_dir))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
