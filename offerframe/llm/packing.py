"""Best-fit packing by large-item matching.

Pieces longer than a third of the capacity fit at most twice in a sequence, so
they are matched first: the longest with the longest partner that still fits.
Shorter pieces, longest first, then go to the smallest remaining gap that
takes them, and open a new sequence only where no gap does.

Only lengths matter for that, and there are at most `capacity` of them.  So
the plan is made from the histogram of piece lengths (capacity rows, whatever
the corpus), where equal sequences are handled together as ranges of sequence
numbers.  It says: of length L, the pieces ranked r0, r0 + 1, ... go to
sequences s0, s0 + 1, ..., k in each, from offset o on.  Pieces are ranked
inside their length without gathering a length in one task, and look their
place up in the plan.  No text and no token id is shuffled.

Defined results: NULL and empty texts are the end id alone; repeated rows are
packed one by one; NULL ids are packed like others.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import rank_within
from .common import drops_white_space, id_text, lean, written

_REMEMBERED = 200_000


@dataclass(frozen=True)
class Params:
    capacity: int = 4096
    end_id: int = 1
    vocabulary: str = "word_bpe_49k.json"  # a file of public_tokenizers, or a path the executors can open
    keep_ids: bool = False                 # also return each piece's token ids


class Remembered(dict):
    """Bounded memory of a function's results: the last `size` to 2 * `size` keys used."""

    def __init__(self, function, size: int):
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# A chunk of plain letters and the marks after it: its parts are encoded on their own.
_WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,!?;:#$%&*|()\"-]*)")


class WordCoder:
    """Text -> its token ids as little-endian 32-bit bytes.

    A tokenizer that drops white space and never joins across it (`drops_white_space`
    reads that from its definition) gives a text the ids of its chunks one after
    the other; each chunk is encoded once while it is remembered.  Texts of any
    other tokenizer are encoded whole.  In a chunk of plain letters followed by marks the
    tokenizer's own splitting parts the two, and its model is asked directly
    for the lower-cased word; all other chunks go through the whole tokenizer.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.coder = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        self.model, self.letters = self.coder.model, _byte_letters()
        self.words = Remembered(self.word, _REMEMBERED)
        self.marks = Remembered(self.whole, 1000)
        self.chunks = Remembered(self.chunk, _REMEMBERED)
        self.apart = drops_white_space(self.coder)  # else a text is encoded as a whole

    def whole(self, chunk: str) -> bytes:
        return np.array(self.coder.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes() if chunk else b""

    def word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])

    def chunk(self, chunk: str) -> bytes:
        parts = _WORD.fullmatch(chunk) if len(chunk) < 100 else None
        if parts is None:
            return self.whole(chunk)
        word, marks = parts.groups()
        coded = self.words[word.lower()]
        return coded + self.marks[marks] if marks else coded

    def forget(self) -> None:
        """Give up what is remembered (at the end of a task: a waiting worker holds the tokenizer alone)."""
        for held in (self.words, self.marks, self.chunks):
            held.clear()
            held.old = {}

    def text(self, text: str) -> bytes:
        if not self.apart:
            return self.whole(text)
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(1)
def word_coder(vocabulary: str) -> WordCoder:
    """One per Python worker: the tokenizer's file is read once."""
    return WordCoder(vocabulary)


def pieces(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32 (and ids)."""
    types = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
             ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if params.keep_ids else [])
    schema = pa.schema(types)
    end = int(params.end_id).to_bytes(4, "little")
    width = 4 * params.capacity

    def run(batches):
        coder = word_coder(params.vocabulary)
        for batch in batches:
            out = []
            texts = pc.fill_null(batch.column("text"), "")
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = coder.text(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)[:len(types)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), types)], schema=schema)
        coder.forget()

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if params.keep_ids else "")
    return id_text(docs, id_col, text_col).mapInArrow(lean(run), ddl)


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Placement of `histogram` (length -> number of pieces).

    Returns rows (length, first rank, first sequence, sequences, pieces per
    sequence, offset) and the number of sequences.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    rows: list[tuple] = []
    used = dict.fromkeys(left, 0)             # ranks given out per length
    gaps: dict[int, list] = {}                # remaining room -> [(first sequence, sequences)]
    sequences = 0

    def place(n: int, first: int, count: int, per: int, offset: int) -> None:
        rows.append((n, used[n], first, count, per, offset))
        used[n] += count * per
        left[n] -= count * per

    def open_gap(room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            heapq.heappush(gaps[room], (first, count))

    rooms: list[int] = []
    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            fit = bisect_left(large, capacity - n + 1) - 1  # the longest partner that fits ...
            while fit >= 0 and left[large[fit]] < (2 if large[fit] == n else 1):
                fit -= 1                                      # ... and is there
            if fit < 0:
                count, partner = left[n], None
            else:
                partner = large[fit]
                count = left[n] // 2 if partner == n else min(left[n], left[partner])
            first, sequences = sequences, sequences + count
            if partner == n:
                place(n, first, count, 2, 0)
            else:
                place(n, first, count, 1, 0)
                if partner:
                    place(partner, first, count, 1, n)
            open_gap(capacity - n - (partner or 0), first, count)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(rooms, n)
            if at == len(rooms):              # no gap takes it: new sequences, filled from the start
                per = capacity // n
                count = max(1, left[n] // per)
                room, first, sequences = capacity, sequences, sequences + count
            else:
                room = rooms[at]
                first, count = heapq.heappop(gaps[room])
                if not gaps[room]:
                    del gaps[room]
                    rooms.pop(at)
            per = min(room // n, left[n])     # a sequence just used has the smallest gap, so it is filled on
            full = min(count, left[n] // per)
            place(n, first, full, per, capacity - room)
            open_gap(room - per * n, first, full)
            open_gap(room, first + full, count - full)
    return np.array(rows, np.int64).reshape(-1, 6), sequences


def pack(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: sequence_id and offset."""
    spark = docs.sparkSession
    cut = pieces(docs, params, id_col, text_col)
    if params.keep_ids:  # a number of each piece that is written with it: ids may repeat or be NULL
        cut = cut.withColumn("row", F.monotonically_increasing_id())
    cut = written(cut, "pieces")
    # One row per length, `capacity` at most.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, _ = plan(counts, params.capacity)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    sent = spark.sparkContext.broadcast(rows[order])  # bounded by the capacity, not by the corpus
    ranked = rank_within(cut.drop("ids"), ["length"], ["doc_id", "piece", "start", "ids_crc32"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["row"] if params.keep_ids else [])

    def look_up(batches):
        rows = sent.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy() - 1
            length = batch.column("length").to_numpy()
            own = rows[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            nth = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(own[:, 2] + nth // own[:, 4]), pa.array(own[:, 5] + nth % own[:, 4] * length)],
                names=[*names, "sequence_id", "offset"])

    ddl = ("doc_id long, piece int, start long, length long, ids_crc32 long, " + ("row long, " if params.keep_ids else "")
           + "sequence_id long, offset long")
    placed = ranked.select(*names, "rank").mapInArrow(lean(look_up), ddl)
    if not params.keep_ids:
        return placed
    return placed.join(cut.select("row", "ids"), "row").drop("row")
