"""Cross-tokenizer alignment: the tokens two tokenizers give for one text, linked where their bytes meet."""

from __future__ import annotations

import hashlib
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, cut_lineage, query, table
from .tokens import _pack, _unpack, load, vocabulary

#: Bytes of text that make up a block at most (a longer document is a block of its own).
BLOCK = 4 << 20
#: Units that are encoded at once, aligned units a task keeps from block to block, and links that are spread out at once.
ENCODED, KEPT, SPREAD = 1 << 13, 1 << 17, 1 << 20
#: A single blank between other characters. No pre-token of A and no piece of B goes on over it, so
#: both end a token there, and the units between such blanks can be encoded one by one.
CUT = re.compile(r"(?<=\S) (?=\S)")

_DOC = ("n_a", "n_b", "n_groups", "n_links")


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Groups of tokens between shared ends, as rows (first A, after last A, first B, after last B) in order.

    ``ends_*`` are the byte ends of all tokens, rising; ``first_*`` bound intervals whose last
    ends are shared. Each interval is divided and conquered, all of one depth at once: the end of
    its middle A token is looked up among the B ends by bisection; if it is no end there, the
    neighbours right and left of it are tried in turn; a shared end divides the interval in two,
    and an interval without one is a group.
    """
    now = np.stack([first_a[:-1], first_a[1:], first_b[:-1], first_b[1:], np.zeros(len(first_a) - 1, np.int64)], axis=1).astype(np.int64)
    now = now[(now[:, 1] > now[:, 0]) & (now[:, 3] > now[:, 2])]
    groups = []
    while len(now):
        al, ar, bl, br, step = now.T
        low, high = al, ar - 2  # the ends inside the interval
        middle = (low + high) // 2
        reach = np.maximum(middle - low, high - middle)
        leaf = (ar - al < 2) | (br - bl < 2) | ((step + 1) // 2 > reach)
        groups.append(now[leaf, :4])
        now, middle = now[~leaf], middle[~leaf]
        if not len(now):
            break
        al, ar, bl, br, step = now.T
        tried = middle + np.where(step % 2 == 1, 1, -1) * ((step + 1) // 2)
        inside = (tried >= al) & (tried <= ar - 2)
        tried = np.clip(tried, al, ar - 2)
        found = np.searchsorted(ends_b, ends_a[tried])
        shared = inside & (ends_b[np.minimum(found, len(ends_b) - 1)] == ends_a[tried])
        none = np.zeros(int(shared.sum()), np.int64)
        i, j = tried[shared] + 1, found[shared] + 1
        left = np.stack([al[shared], i, bl[shared], j, none], axis=1)
        right = np.stack([i, ar[shared], j, br[shared], none], axis=1)
        rest = now[~shared]
        rest[:, 4] += 1
        now = np.concatenate([left, right, rest])
    out = np.concatenate(groups) if groups else np.zeros((0, 4), np.int64)
    return out[np.argsort(out[:, 0], kind="stable")]


def _group_pairs(ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of the groups as (group, pair of ids in one number, links of that pair), a large group by its distinct ids."""
    na, nb = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    small = np.flatnonzero(na * nb <= SPREAD)
    links = (na * nb)[small]
    owner = np.repeat(small, links)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(links) - links, links)
    a, b = ids_a[groups[owner, 0] + place // nb[owner]], ids_b[groups[owner, 2] + place % nb[owner]]
    found = [(owner, (a << 32) | b, np.ones(len(owner), np.int64))]
    for g in np.flatnonzero(na * nb > SPREAD):
        a, ca = np.unique(ids_a[groups[g, 0] : groups[g, 1]], return_counts=True)
        b, cb = np.unique(ids_b[groups[g, 2] : groups[g, 3]], return_counts=True)
        pair = ((a[:, None] << 32) | b[None, :]).ravel()
        found.append((np.full(len(pair), g), pair, (ca[:, None] * cb[None, :]).ravel()))
    owner, pair, links = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(owner, kind="stable")
    return owner[order], pair[order], links[order]


def byte_level() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = load(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_level()
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in map(self.a.id_to_token, range(size))]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]
        # Ids as they are written in a group: before another one, as the last of A, as the last of a group, as the last of all.
        self.said_a = [np.array([f"{k}{mark}" for k in range(size)], object) for mark in (",", "|")]
        self.said_b = [np.array([f"{k}{mark}" for k in range(len(pieces))], object) for mark in (",", ";", "")]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece goes on over a blank: texts cannot be cut there")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def encode(self, units: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """[A ids, B ids, tokens of each unit by A and by B] of units that begin with a blank, and which units' bytes come back."""
        good = np.ones(len(units), bool)
        both = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)], self.b.encode([u[1:] for u in units], num_threads=1)
        raw = list(map(str.encode, units))
        flat, counts = self._flat(both)
        if not self._same_bytes(raw, flat, counts):
            for n, (unit, a, b) in enumerate(zip(raw, *both)):
                if b"".join(map(self.bytes_a.__getitem__, a)) != unit or b"".join(map(self.bytes_b.__getitem__, b)) != unit:
                    good[n] = False
                    both[0][n], both[1][n] = [], []
            flat, counts = self._flat(both)
        return flat + counts, good

    def _flat(self, both) -> tuple[list[np.ndarray], list[np.ndarray]]:
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in both]
        return [np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in zip(both, counts)], counts

    def _same_bytes(self, raw: list[bytes], flat: list[np.ndarray], counts: list[np.ndarray]) -> bool:
        """Whether the bytes of all units come back: as many for each unit, and the same behind one another."""
        whole, lengths = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
        for ids, n, sizes, of in zip(flat, counts, (self.size_a, self.size_b), (self.bytes_a, self.bytes_b)):
            ends = np.r_[0, np.cumsum(sizes[ids])][np.r_[0, np.cumsum(n)]]
            if not np.array_equal(np.diff(ends), lengths) or b"".join(map(of.__getitem__, ids.tolist())) != whole:
                return False
        return True


class _Codes(dict):
    """A number for each unit, in order of first use."""

    def __missing__(self, unit):
        self[unit] = n = len(self)
        return n


class _Units:
    """The alignment of all units met so far."""

    def __init__(self, tokenizers: _Tokenizers):
        self.tokenizers = tokenizers
        self.codes = _Codes()
        self.said: list[str] = []
        self.good = np.zeros(0, bool)
        self.figures = {name: np.zeros(0, np.int64) for name in _DOC}
        self.sizes = self.pairs = self.links = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def look_up(self, text: str) -> np.ndarray:
        units = CUT.split(text)
        return np.fromiter(map(self.codes.__getitem__, units), np.int64, len(units))

    def align(self) -> None:
        """Align the units that were met since the last time."""
        new = list(islice(self.codes, len(self.said), None))
        made = [self._aligned([f" {u}" for u in new[k : k + ENCODED]]) for k in range(0, len(new), ENCODED)]
        if made:
            good, figures, sizes, pairs, links = zip(*made)
            self.good = np.concatenate([self.good, *good])
            self.figures = {name: np.concatenate([self.figures[name], *(f[name] for f in figures)]) for name in _DOC}
            self.sizes, self.pairs, self.links = (np.concatenate([old, *more]) for old, more in ((self.sizes, sizes), (self.pairs, pairs), (self.links, links)))
            self.first = np.r_[0, np.cumsum(self.sizes)]

    def _aligned(self, units: list[str]) -> tuple:
        (ids_a, ids_b, n_a, n_b), good = self.tokenizers.encode(units)
        first_a, first_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
        groups = cuts(np.cumsum(self.tokenizers.size_a[ids_a]), np.cumsum(self.tokenizers.size_b[ids_b]), first_a, first_b)
        unit_of = np.searchsorted(first_a, groups[:, 0], side="right") - 1
        n_groups = np.bincount(unit_of, minlength=len(units))
        n_links = _sums((groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2]), unit_of, len(units))
        owner, pairs, links = _group_pairs(ids_a, ids_b, groups)
        # All ids in the order they are written, each with the mark behind it.
        commas_a, bars = self.tokenizers.said_a
        commas_b, semicolons, plain = self.tokenizers.said_b
        said_a, said_b = commas_a[ids_a], commas_b[ids_b]
        last_a, last_b, ends = groups[:, 1] - 1, groups[:, 3] - 1, first_b[1:][n_b > 0] - 1
        said_a[last_a], said_b[last_b] = bars[ids_a[last_a]], semicolons[ids_b[last_b]]
        said_b[ends] = plain[ids_b[ends]]
        said = np.empty(len(ids_a) + len(ids_b), object)
        said[np.arange(len(ids_a)) + np.repeat(groups[:, 2], groups[:, 1] - groups[:, 0])] = said_a
        said[np.arange(len(ids_b)) + np.repeat(groups[:, 1], groups[:, 3] - groups[:, 2])] = said_b
        said, at = said.tolist(), (first_a + first_b).tolist()
        self.said += ["".join(said[a:b]) for a, b in zip(at, at[1:])]
        sizes = np.bincount(unit_of[owner], minlength=len(units))
        return good, dict(zip(_DOC, (n_a, n_b, n_groups, n_links))), sizes, pairs, links


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges behind one another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by owner; owners rise."""
    total = np.r_[0, np.cumsum(values)]
    bounds = np.searchsorted(of, np.arange(n + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


def _align_block(units: _Units, texts: list[str | None]) -> dict[str, object]:
    """Alignment of some documents: their figures, and how often each has each pair of ids."""
    docs = [units.look_up(t) if t else np.zeros(0, np.int64) for t in texts]
    units.align()
    figures = {name: np.zeros(len(docs), np.int64) for name in _DOC}
    digests = [""] * len(docs)
    counts = np.zeros(len(docs), np.int64)
    pairs, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, codes in enumerate(docs):
        if not len(codes) or not units.good[codes].all():
            continue
        for name in _DOC:
            figures[name][k] = units.figures[name][codes].sum()
        digest = hashlib.sha256()
        for at in range(0, len(codes), SPREAD):
            digest.update((";" if at else "").encode())
            digest.update(";".join(map(units.said.__getitem__, codes[at : at + SPREAD].tolist())).encode())
        digests[k] = digest.hexdigest()
        own, times = np.unique(codes, return_counts=True)
        sizes = units.sizes[own]
        at = _ranges(units.first[own], sizes)
        held, back = np.unique(units.pairs[at], return_inverse=True)
        total = np.zeros(len(held), np.int64)
        np.add.at(total, back, units.links[at] * np.repeat(times, sizes))
        counts[k] = len(held)
        pairs.append(held)
        links.append(total)
    keys, code = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.concatenate(links)
    step = np.diff(code, prepend=0)
    begins = (np.cumsum(counts) - counts)[counts > 0]
    step[begins] = code[begins]
    return figures | {
        "groups_sha256": digests,
        "_packed": _pack(counts, step, total & 0xFFFFFFFF, total >> 32),
        "_entries": len(code),
        "_keys": keys, "_holders": np.bincount(code, minlength=len(keys)), "_at": np.arange(len(keys)),
    }


def _align_blocks(paths, text, names):
    def run(batches):
        units = None
        for batch in batches:
            sizes = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))]
            row = 0
            while row < batch.num_rows:
                if units is None or len(units.said) > KEPT:
                    units = _Units(units.tokenizers if units else _Tokenizers(*paths))
                end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + BLOCK, side="right")) - 1)
                part = batch.slice(row, end - row)
                out = _align_block(units, part.column(text).to_pylist())
                n = part.num_rows
                each = [pa.array(out[c]) for c in _DOC] + [pa.array(out["groups_sha256"])] + [part.column(c) for c in names]
                listed = [*each, pa.array(out["_keys"]), pa.array(out["_holders"]), pa.array(out["_at"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([out["_packed"]], pa.binary()), pa.array([out["_entries"]], pa.int64())]
                    + [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.concat_arrays([x])) for x in listed],
                    names=["_packed", "_entries", *_DOC, "groups_sha256", *names, "_keys", "_holders", "_at"],
                )
                row = end
                del out, listed, each
                pa.default_memory_pool().release_unused()

    return run


def _score_blocks(names):
    def run(batches):
        """Blocks with what is known of their pairs to their documents, with the links that are best and the sum of counts."""
        for batch in batches:
            for k in range(batch.num_rows):
                get = {c: batch.column(c)[k].values for c in (*_DOC, "groups_sha256", *names)}
                n, entries = len(get["n_a"]), batch.column("_entries")[k].as_py()
                known = batch.column("_known")[k].values
                at, count, best = (
                    (known.field(f).to_numpy().astype(np.int64) for f in ("at", "count", "best")) if known is not None else (np.zeros(0, np.int64),) * 3
                )
                counts, best_of = (np.zeros(int(at.max(initial=-1)) + 1, np.int64) for _ in range(2))
                counts[at], best_of[at] = count, best
                held, step, low, high = _unpack(batch.column("_packed")[k].as_py(), n, entries, entries, entries)
                doc = np.repeat(np.arange(n), held)
                run_ = np.cumsum(step)
                pair = run_ - np.r_[0, run_][(np.cumsum(held) - held)[doc]]
                links = low + (high << 32)
                yield pa.RecordBatch.from_arrays(
                    [*(get[c] for c in (*names, *_DOC)), pa.array(_sums(links * best_of[pair], doc, n)), pa.array(_sums(links * counts[pair], doc, n)), get["groups_sha256"]],
                    names=[*names, *_DOC, "n_best", "count_sum", "groups_sha256"],
                )

    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text, by default) with how the tokens of A and B meet in each text.

    A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model. A task turns
    its documents into blocks. Each different unit is encoded once by both, its tokens are grouped
    at shared ends (see ``cuts``), and a document is the sum of its units; a task keeps a bounded
    number of aligned units from block to block. A block keeps how often each document links each
    pair of ids. How many documents hold a pair is added up over blocks, one row per block and
    pair, and joined back to the blocks, so a pair in every document is one row for each block.

    Null and empty texts, and texts whose tokens do not give back their bytes, have no tokens:
    all figures are 0 and the digest is ''. Repeated rows are documents of their own. An empty
    table gives an empty one. A text longer than a block is a block of its own. Kept columns that
    have the name of a result or begin with an underscore are refused.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    results = (*_DOC, "n_best", "count_sum", "groups_sha256")
    if any(c.startswith("_") or c.lower() in results for c in keep):
        raise ValueError(f"kept columns may not begin with an underscore nor be named as a result: {keep}")
    spark = docs.sparkSession
    raw = docs.select(F.col(text).alias("_text"), *keep)
    types = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    figures = "".join(f", {c} array<bigint>" for c in _DOC)
    kept = "".join(f", `{c}` array<{types[c]}>" for c in keep)
    schema = f"_packed binary, _entries bigint{figures}, groups_sha256 array<string>{kept}, _keys array<bigint>, _holders array<bigint>, _at array<bigint>"
    with batches_of(spark, rows=4096, size=BLOCK):
        blocks = raw.mapInArrow(_align_blocks((path_a, path_b), "_text", keep), schema)
        blocks = cut_lineage(blocks.withColumn("_block", F.monotonically_increasing_id()))
    uses = blocks.select("_block", F.explode(F.arrays_zip("_keys", "_holders", "_at")).alias("u")).select(
        "_block", F.col("u._keys").alias("pair"), F.col("u._holders").alias("holders"), F.col("u._at").alias("at")
    )
    counts = uses.groupBy("pair").agg(F.sum("holders").alias("count")).withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    scored = counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))
    known = uses.join(scored, "pair").groupBy("_block").agg(F.collect_list(F.struct("at", "count", "best")).alias("_known"))
    filled = blocks.drop("_keys", "_holders", "_at").join(known, "_block", "left").drop("_block")
    kept = "".join(f"`{c}` {types[c]}, " for c in keep)
    out = f"{kept}{', '.join(f'{c} bigint' for c in (*_DOC, 'n_best', 'count_sum'))}, groups_sha256 string"
    with batches_of(spark, rows=4, size=4 * BLOCK):
        return cut_lineage(filled.mapInArrow(_score_blocks(keep), out))


@query()
def op11_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return align_tokens(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
