"""Token counts: pieces counted once per distinct pre-token, joined to each document's frequencies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, query, rows_per_batch, table

#: White space, letters and digits as the byte-level tokenizer's own pattern takes them.
_S = r"\x09-\x0D\x20\x85\xA0  -     　"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
SPECIAL = "<|endoftext|>"
CONTEXT = 1024
#: Bytes of pre-tokens that make up a block at most (a longer document is a block of its own).
BLOCK = 40 << 20
#: Documents that cross to Python at once.
ROWS = 1000
#: Pre-tokens of a block that are counted at once.
STRETCH = 1 << 18

def pre_tokens(text: Column, special: str = SPECIAL) -> Column:
    """The pre-tokens of a text, those of the stretches between special strings; the strings themselves are left out."""
    def of(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(PRE_TOKEN), F.lit(0))

    stretches = F.split(text, rf"\Q{special}\E")
    return F.when(F.contains(text, F.lit(special)), F.flatten(F.transform(stretches, of))).otherwise(of(text))


def _gathered(batches):
    """Batches put together up to the size of a block."""
    held, size = [], 0
    for batch in batches:
        if size + batch.nbytes > BLOCK and held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(batches):
    """Batches of (pre-tokens, ...) to blocks: the other columns as lists, the distinct pre-tokens, and how often each document has each."""
    for batch in _gathered(batches):
        while batch.num_rows:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            tokens = lists.values
            size = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset :][offsets] if len(tokens) else offsets
            n = max(1, int(np.searchsorted(size[1:] - size[0], BLOCK)))
            offsets = offsets[: n + 1]
            coded = tokens.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            words, codes = coded.dictionary, coded.indices.to_numpy()
            found, row = [], 0
            while row < n:
                end = min(n, max(row + 1, int(np.searchsorted(offsets, offsets[row] + STRETCH, side="right")) - 1))
                owner = np.repeat(np.arange(row, end, dtype=np.int64), np.diff(offsets[row : end + 1]))
                pair, freq = np.unique(owner * len(words) + codes[offsets[row] - offsets[0] : offsets[end] - offsets[0]], return_counts=True)
                found.append((*(x.astype(np.int32) for x in np.divmod(pair, max(1, len(words)))), freq.astype(np.int32)))
                row = end
            doc, code, freq = (np.concatenate(c) for c in zip(*found))
            step = np.where(np.diff(doc, prepend=-1) > 0, code, np.diff(code, prepend=0))
            packed = _pack(np.bincount(doc, minlength=n), step, freq)
            lists = [words, *(c.slice(0, n) for c in batch.columns[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([packed]), pa.array([len(doc)], pa.int32()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)],
                names=["_packed", "_pairs", "_words", *batch.schema.names[1:]],
            )
            batch = batch.slice(n)
            del lists, tokens, coded, words, codes, found, doc, code, freq, step, packed
            pa.default_memory_pool().release_unused()


def _pack(*columns: np.ndarray) -> bytes:
    """Numbers of four bytes, compressed by byte place."""
    planes = [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns]
    return pa.Codec("zstd").compress(b"".join(planes), asbytes=True)


def _unpack(packed: bytes, *sizes: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(packed, 4 * sum(sizes), asbytes=True), np.uint8)
    out = []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel().astype(np.int64))
        raw = raw[4 * n :]
    return out


def load(path: str):
    """The tokenizer of a file, working in the thread that calls it: a task has one core."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special string inside a text is plain text
    return tokenizer


def _count_pieces(path):
    def run(batches):
        """Uses of pre-tokens, sorted, to their numbers of pieces; each pre-token is encoded where its run begins."""
        tokenizer = load(path)  # a pre-token is never a special token
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(0))
            words = runs.values.to_pylist()
            known = words[0] == last
            pieces = [len(e.ids) for e in tokenizer.encode_batch_fast(words[known:], add_special_tokens=False)]
            pieces = [count, *pieces] if known else pieces
            last, count = words[-1], pieces[-1]
            each = np.repeat(np.array(pieces, np.int32), np.diff(np.r_[0, runs.run_ends.to_numpy()]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(each)], names=[*batch.schema.names[1:], "_pieces"])

    return run


def _sum_blocks(names):
    def run(batches):
        """Blocks with the pieces of their pre-tokens to their documents with tokens."""
        for batch in batches:
            for k in range(batch.num_rows):
                get = {name: batch.column(name)[k].values for name in ("_known", "_special", *names)}
                known = np.zeros(0, np.int64) if get["_known"] is None else get["_known"].to_numpy()
                pairs, n_docs = batch.column("_pairs")[k].as_py(), len(get["_special"])
                counts, step, freq = _unpack(batch.column("_packed")[k].as_py(), n_docs, pairs, pairs)
                doc = np.repeat(np.arange(n_docs), counts)
                first = (np.cumsum(counts) - counts)[doc]
                run = np.cumsum(step)
                code = run - np.r_[0, run][first]
                pieces = np.ones(int(code.max(initial=-1)) + 1, np.int64)
                pieces[known >> 32] = known & 0xFFFFFFFF
                rows = [get[c] for c in names]
                total = np.bincount(doc, freq * pieces[code], minlength=n_docs).astype(np.int64)
                total += get["_special"].to_numpy()
                yield pa.RecordBatch.from_arrays([*rows, pa.array(total)], names=[*names, "_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of the documents (all but the text, by default) with the count of tokens under ``name``.

    Pre-tokens are found in the JVM. A task turns a batch of documents into one block: its distinct
    pre-tokens, and numbers for how often each document has each. The blocks are written once. The
    pre-tokens of all blocks meet by their text, each is encoded once by the tokenizers library with
    the vocabulary file at ``path``, the numbers of pieces are joined back to the blocks, and each
    block sums up its documents; ids are never kept. A common pre-token has one row for each block, not for each
    document.

    Null and empty texts have 0 tokens. A special string inside a text is one token, as is the
    library's default. Repeated rows count each; an empty table gives an empty one. Kept columns
    that begin with an underscore are refused.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    if any(c.startswith("_") for c in keep):
        raise ValueError("kept columns may not begin with an underscore")
    t = F.coalesce(F.col(text), F.lit(""))
    raw = docs.select(pre_tokens(t).alias("_words"), (F.size(F.split(t, rf"\Q{SPECIAL}\E")) - 1).alias("_special"), *keep)
    types = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    lists = ", ".join(f"`{c}` array<{types[c]}>" for c in ("_special", *keep))
    blocks = raw.mapInArrow(_blocks, f"_packed binary, _pairs int, _words array<string>, {lists}")
    with rows_per_batch(docs.sparkSession, ROWS):
        blocks = cut_lineage(blocks.withColumn("_block", F.monotonically_increasing_id()))
    uses = blocks.select(F.posexplode("_words").alias("_at", "_word"), "_block").select("_word", "_block", "_at")
    pieces = uses.repartition("_word").sortWithinPartitions("_word").mapInArrow(_count_pieces(path), "_block bigint, _at int, _pieces int")
    # Place and pieces in one number; a pre-token of one piece, the usual case, needs none.
    both = F.shiftleft(F.col("_at").cast("bigint"), 32) + F.col("_pieces")
    known = pieces.where("_pieces > 1").groupBy("_block").agg(F.collect_list(both).alias("_known"))
    filled = blocks.drop("_words").join(known, "_block", "left")
    kept = ", ".join(f"`{c}` {types[c]}" for c in keep)
    return filled.mapInArrow(_sum_blocks(keep), f"{kept}, _tokens bigint").withColumnRenamed("_tokens", name)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op4_token_counts(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("n_bytes", F.octet_length(text).cast("bigint"))
    return count_tokens(docs, vocabulary(), keep=["doc_id", "n_bytes"]).withColumn("over_limit", F.col("n_tokens") > CONTEXT)
