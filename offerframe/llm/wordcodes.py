"""BPE encoding and decoding through a table of distinct words.

Encoding.  A task splits its texts at white space, which the tokenizer drops
and never joins across, and cuts them into blocks.  A block is a list of its
different words, dealt by hash into buckets, and every text as positions in that
list.  The words of a bucket, from all blocks, meet in one task: its part of the
table of distinct words, where every word is encoded once.  Their ids go back to
the blocks, and the positions put them in order.

So of a text only compressed positions cross the network, and a word crosses
once per block that holds it, however often it occurs there; a word found
everywhere is one of many in its bucket.  A block is about `block_bytes` of text,
or one text that is longer, and is all that a task holds of the texts.  There
are as many buckets as the table's size asks for, so that the distinct words of
one, which a task holds, stay few however large the corpus.  Tasks that are run
again must meet the same rows in the same order, as those of a stored table are.

Decoding.  The vocabulary's table (id, piece) is bounded by its file, not by the
documents, so every task gets it, and ids are joined to their pieces where they
lie, a batch at a time.

Defined results: NULL texts are empty texts, NULL id lists empty lists; both
give no ids and the empty text.  Ids that the vocabulary does not have are left
out, as the tokenizer's decoder does.  Control strings of special tokens inside
a text become those tokens, as the tokenizer reads them.  Rows may repeat; the
columns named in `keep` come back with their row, whatever they hold.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drops_white_space, lean, ship, text_bytes
from .resample import crc_on

_SPACES = np.zeros(256, bool)
_SPACES[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = True


@dataclass(frozen=True)
class Params:
    vocabulary: str = "word_bpe_49k.json"  # a file of public_tokenizers, or a path the executors can open
    block_bytes: int = 16 << 20            # text of a block
    buckets: int | None = None             # of distinct words; None: one for every `bucket_bytes` of the table
    bucket_bytes: int = 16 << 20


@lru_cache(2)
def tokenizer(vocabulary: str):
    """One per process."""
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    coder = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    coder.no_truncation()
    coder.no_padding()
    return coder


# --- packing ------------------------------------------------------------------------------

_ZSTD = pa.Codec("zstd", compression_level=3)


def pack(*parts: bytes) -> bytes:
    """Byte strings as one compressed byte string."""
    raw = b"".join([np.array([len(parts), *map(len, parts)], "<i8").tobytes(), *parts])
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def unpack(packed: bytes) -> list[bytes]:
    raw = _ZSTD.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    sizes = np.frombuffer(raw, "<i8", n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [raw[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first, then all second ones ...: small numbers then compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


# --- texts -> blocks ----------------------------------------------------------------------

# A block's own row has bucket -1: kept columns in `head`, words per text and positions in `data`.
# Its other rows hold the words of a bucket and, with each, its frequency class in the block.
_ROWS = "dest long, block long, bucket int, head binary, data binary"
_ROW_TYPES = pa.schema([("dest", pa.int64()), ("block", pa.int64()), ("bucket", pa.int32()), ("head", pa.binary()), ("data", pa.binary())])


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts (binary, NULL: empty) -> (different words, number of every word, words per text).

    Works on the texts' own bytes; no word becomes a Python object."""
    raw, offs = text_bytes(column)
    inside = ~_SPACES[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offs[offs < len(raw)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    del inside, first
    sizes = np.diff(np.searchsorted(starts, offs))
    # Each word with the white space behind it, end to end: the bytes are used as they lie.
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(np.ascontiguousarray(raw))])
    del starts
    coded = words.dictionary_encode()
    padded = coded.dictionary
    texts = pa.Array.from_buffers(pa.large_string(), len(padded), padded.buffers(), offset=padded.offset)
    bare = pc.ascii_rtrim_whitespace(texts).cast(pa.large_binary()).dictionary_encode()
    return bare.dictionary, bare.indices.to_numpy()[coded.indices.to_numpy()], sizes


def code_order(classes: np.ndarray) -> np.ndarray:
    """Order of a block's words, given bucket by bucket: frequent classes first, which makes positions small numbers."""
    return np.argsort(-classes.astype(np.int64), kind="stable")


def block_rows(texts: pa.Array, heads: pa.RecordBatch, block: int, buckets: int):
    """The rows of one block."""
    words, codes, sizes = split_words(texts)
    raw, ends = text_bytes(words)
    bucket = crc_on(raw, ends[:-1], ends[1:], np.zeros(len(words), np.uint32)) % np.uint32(buckets)
    classes = np.log2(np.bincount(codes, minlength=len(words)) + 1).astype(np.uint8)
    by_bucket = np.argsort(bucket, kind="stable").astype(np.int32)
    position = np.empty(len(words), np.int32)
    position[by_bucket[code_order(classes[by_bucket])]] = np.arange(len(words), dtype=np.int32)
    dest, numbers, data = [block], [-1], [pack(sizes.astype("<i8").tobytes(), planes(position[codes]))]
    del codes, position
    raw, ends = text_bytes(words.take(pa.array(by_bucket)))
    bucket, classes = bucket[by_bucket].astype(np.int64), classes[by_bucket]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(words)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        dest.append(int(bucket[a]))
        numbers.append(dest[-1])
        data.append(pack(classes[a:b].tobytes(), planes(np.diff(ends[a:b + 1])), raw[ends[a]:ends[b]].tobytes()))
    head = [_ipc(heads)] + [None] * (len(dest) - 1)
    for a in range(0, len(dest), 2000):
        b = min(a + 2000, len(dest))
        yield pa.RecordBatch.from_arrays([pa.array(dest[a:b], pa.int64()), pa.array([block] * (b - a), pa.int64()),
                                          pa.array(numbers[a:b], pa.int32()), pa.array(head[a:b], pa.binary()),
                                          pa.array(data[a:b], pa.binary())], schema=_ROW_TYPES)


def _to_blocks(keep: list[str], buckets: int, p: Params):
    def run(batches):
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def blocks():
            nonlocal made, held, size
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from block_rows(batch.column("_text"), batch.select(keep), task << 32 | made, buckets)
            made, held, size = made + 1, [], 0

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy().astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = int(np.searchsorted(ends, done + p.block_bytes - size, side="right"))
                if to == at and not held:
                    to = at + 1  # a longer text is a block of its own
                if to > at:
                    held.append(batch.slice(at, to - at))
                    size += int(ends[to - 1]) - done
                    at = to
                if at < batch.num_rows:
                    yield from blocks()
        if held:
            yield from blocks()

    return run


# --- the table of distinct words ----------------------------------------------------------

def encode_words(batches, coder):
    """Rows by bucket -> the same rows with ids in place of words; every word of a bucket is encoded once."""
    narrow = coder.get_vocab_size(with_added_tokens=True) <= 1 << 16
    table, bucket = {}, None
    for batch in batches:
        out = []
        for number, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
            if number < 0:
                out.append(data)
                continue
            if number != bucket:
                table, bucket = {}, number
            classes, sizes, raw = unpack(data)
            ends = np.cumsum(from_planes(sizes)).tolist()
            words = [raw[a:e] for a, e in zip([0, *ends], ends)]
            new = [w for w in dict.fromkeys(words) if w not in table]
            for w, e in zip(new, coder.encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)):
                table[w] = np.array(e.ids, "<u2" if narrow else "<u4").tobytes()
            ids = [table[w] for w in words]
            counts = np.array([len(i) for i in ids]) // (2 if narrow else 4)
            out.append(pack(classes, counts.astype("<u4").tobytes(), b"".join(ids)))
        if out:
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), batch.column("head"),
                                              pa.array(out, pa.binary())], names=["block", "bucket", "head", "data"])


# --- blocks -> ids ------------------------------------------------------------------------

def _assemble(keep: pa.Schema, narrow: bool):
    """Rows of whole blocks (its own row first, then its words by bucket) -> kept columns and ids of each text."""
    schema = pa.schema([*keep, ("ids", pa.list_(pa.int32()))])
    kind = "<u2" if narrow else "<u4"

    def solve(head, data, parts):
        sizes, codes = unpack(data)
        sizes, codes = np.frombuffer(sizes, "<i8"), from_planes(codes)
        classes = np.concatenate([np.frombuffer(c, np.uint8) for c, _, _ in parts] or [np.zeros(0, np.uint8)])
        counts = np.concatenate([np.frombuffer(n, "<u4") for _, n, _ in parts] or [np.zeros(0, "<u4")])
        raw = np.frombuffer(b"".join(i for _, _, i in parts), kind).astype("<i4").tobytes()
        ends = 4 * np.cumsum(counts.astype(np.int64))
        words = [raw[e - 4 * n:e] for n, e in zip(counts.tolist(), ends.tolist())]
        words = [words[k] for k in code_order(classes)]
        with pa.ipc.open_stream(head) as stream:
            heads = stream.read_all().combine_chunks().to_batches()
        heads = heads[0] if heads else None
        last = np.cumsum(sizes)
        for a in range(0, len(sizes), 500):
            b = min(a + 500, len(sizes))
            texts = [b"".join([words[c] for c in codes[e - n:e].tolist()]) for n, e in zip(sizes[a:b].tolist(), last[a:b].tolist())]
            offs = np.concatenate([[0], np.cumsum([len(t) // 4 for t in texts])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.frombuffer(b"".join(texts), "<i4"), pa.int32()))
            part = heads.slice(a, b - a) if heads is not None else None
            columns = [part.column(k).cast(f.type) for k, f in enumerate(keep)]
            yield pa.RecordBatch.from_arrays([*columns, ids], schema=schema)

    def run(batches):
        own, parts = None, []
        for batch in batches:
            for bucket, head, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "head", "data"))):
                if bucket < 0:
                    if own is not None:
                        yield from solve(*own, parts)
                    own, parts = (head, data), []
                else:
                    parts.append(unpack(data))
        if own is not None:
            yield from solve(*own, parts)

    return run


def _buckets(df: DataFrame, p: Params) -> int:
    """One bucket for every `bucket_bytes` of the table by Spark's own estimate, between 256 and 2**16."""
    if p.buckets:
        return p.buckets
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(256, min(1 << 16, size // p.bucket_bytes))


def encode(docs: DataFrame, params: Params = Params(), text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           ids_col: str = "ids") -> DataFrame:
    """The columns `keep` and the token ids of `text_col` (array of int) per row of `docs`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    p = params
    if not drops_white_space(tokenizer(p.vocabulary)):
        raise ValueError("this tokenizer joins across white space: its words cannot be encoded apart")
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                       F.lit(None).cast("boolean").alias("_row"),  # a block without kept columns still has its rows
                       F.col(text_col).cast("string").cast("binary").alias("_text"))
    heads = rows.drop("_text")
    narrow = tokenizer(p.vocabulary).get_vocab_size(with_added_tokens=True) <= 1 << 16
    blocks = rows.mapInArrow(lean(_to_blocks(heads.columns, _buckets(docs, p), p)), _ROWS)
    coded = (blocks.repartition("dest").sortWithinPartitions("bucket", "block")
             .mapInArrow(lean(lambda batches: encode_words(batches, tokenizer(p.vocabulary))), "block long, bucket int, head binary, data binary"))
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in heads.schema.fields] + ["ids array<int>"])
    back = (coded.repartition("block").sortWithinPartitions("block", "bucket")
            .mapInArrow(lean(_assemble(to_arrow_schema(heads.schema), narrow)), ddl))
    return back.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("ids").alias(ids_col))


# --- decoding -----------------------------------------------------------------------------

def pieces(p: Params) -> list[str | None]:
    """The vocabulary's table: the piece of every id, as many as its file has (None where it skips an id)."""
    vocabulary = tokenizer(p.vocabulary).get_vocab(with_added_tokens=True)
    table: list[str | None] = [None] * (max(vocabulary.values(), default=-1) + 1)
    for piece, k in vocabulary.items():
        table[k] = piece
    return table


def decode(encoded: DataFrame, params: Params = Params(), ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           text_col: str = "text") -> DataFrame:
    """The columns `keep` and the text of the token ids `ids_col` (array of int) per row: the ids' pieces, one space
    between them, special tokens included."""
    spark = encoded.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(pieces(params))  # bounded by the vocabulary's file
    names = [f"k{i}" for i in range(len(keep))]
    rows = encoded.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(ids_col).cast("array<int>").alias("_ids"))

    def run(batches):
        table = sent.value
        for batch in batches:
            lists = batch.column("_ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy()
            known = (flat >= 0) & (flat < len(table))
            found = [table[k] for k in np.where(known, flat, 0).tolist()]
            if not known.all() or None in found:
                found = [t if ok else None for t, ok in zip(found, known.tolist())]
            ends = np.cumsum(sizes).tolist()
            texts = [" ".join([t for t in found[e - n:e] if t is not None]) for n, e in zip(sizes.tolist(), ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "_out"])

    ddl = ", ".join([f"{n} {rows.schema[n].dataType.simpleString()}" for n in names] + ["_out string"])
    out = rows.mapInArrow(lean(run), ddl)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("_out").alias(text_col))
