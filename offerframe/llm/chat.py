"""Chat formatting by token-level assembly.

Every turn is encoded on its own: control strings inside its text are escaped,
the text is encoded by a byte-level vocabulary, and the markers around it are
spliced in as reserved ids beyond that vocabulary, so no text can ever produce
a marker.  A conversation is its segments end to end.  The loss mask comes
from the segments' lengths: prefix sums give each segment's place, a
difference array marks where the loss starts (+1) and ends (-1), and its
prefix sum is the mask.

Template (as text):  `### User:\\n` text ` </turn>\\n`, likewise `### Assistant:`
and `### System:`; any other role is `### Role:\\n` role ` </role>\\n` text
` </turn>\\n`.  Escaping puts a backslash before every backslash, `#` and
`</` in a text; removing one backslash before any character reverses it.

Turns are encoded where their rows are read; only ids are shuffled, by
conversation, and a task streams over its sorted turns: a conversation of any
length passes through without being held.  Output rows are segments in order.

Defined results: NULL text is empty, NULL role is ''; turns are ordered by
turn number (NULL first), then role and text, so repeated rows and ties have
one order; rows with a NULL conv_id form one conversation.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Markers by their reserved id's distance from the end of the vocabulary, and the text they stand for.
MARKERS = ("### User:\n", "### Assistant:\n", "### System:\n", "### Role:\n", " </role>\n", " </turn>\n")
USER, ASSISTANT, SYSTEM, ROLE, ROLE_END, TURN_END = range(6)
_KNOWN = {"user": USER, "assistant": ASSISTANT, "system": SYSTEM}
_ESCAPE = re.compile(r"\\|#|</")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Params:
    vocabulary: str = "byte_bpe_50k.json"   # a file of public_tokenizers, or a path the executors can open
    loss_roles: tuple = ("assistant",)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Coder:
    """Byte-level encoding and decoding with reserved ids after the vocabulary."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.first = self.tokenizer.get_vocab_size()  # the first reserved id

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""


@lru_cache(2)
def coder(vocabulary: str) -> Coder:
    return Coder(vocabulary)


_SEGMENT = "conv_id long, turn long, role string, tie string, ids binary, loss_from int, loss_to int"


def _encode_turns(p: Params):
    def run(batches):
        code = coder(p.vocabulary)
        mark = lambda k: np.array([code.first + k], np.int32)
        for batch in batches:
            roles = [r or "" for r in batch.column("role").to_pylist()]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bodies = code.encode([escape(t) for t in texts])
            names = iter(code.encode([escape(r) for r in roles if r not in _KNOWN]))
            ids, spans = [], []
            for role, body in zip(roles, bodies):
                head = [mark(_KNOWN[role])] if role in _KNOWN else [mark(ROLE), next(names), mark(ROLE_END)]
                start = sum(map(len, head))
                ids.append(np.concatenate([*head, body, mark(TURN_END)]).astype("<i4").tobytes())
                spans.append((start, start + len(body)) if role in p.loss_roles else (0, 0))
            ties = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(roles, pa.string()), pa.array(ties, pa.string()),
                 pa.array(ids, pa.binary()), pa.array([s for s, _ in spans], pa.int32()),
                 pa.array([e for _, e in spans], pa.int32())],
                names=["conv_id", "turn", "role", "tie", "ids", "loss_from", "loss_to"])

    return run


def format_conversations(turns: DataFrame, params: Params = Params(), conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formatted segments: conv_id, position (place of its first id in the conversation), ids (little-endian
    32-bit), mask (one byte per id, 1 under the loss).  Partitioned by conversation, in order."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    encoded = rows.mapInArrow(_encode_turns(params), _SEGMENT)
    dealt = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")

    def assemble(batches):
        last, at = None, 0
        for batch in batches:
            convs = batch.column("conv_id").to_pylist()
            ids = batch.column("ids").to_pylist()
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            # Loss marks of the whole batch: +1 where a span starts, -1 where it ends, then a prefix sum.
            change = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
            np.add.at(change, starts + batch.column("loss_from").to_numpy(), 1)
            np.add.at(change, starts + batch.column("loss_to").to_numpy(), -1)
            mask = np.cumsum(change[:-1]).astype(np.uint8).tobytes()
            places = []
            for conv, length in zip(convs, lengths.tolist()):
                at = at if (conv,) == last else 0
                last = (conv,)
                places.append(at)
                at += length
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(places, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([mask[s:e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary())],
                names=["conv_id", "position", "ids", "mask"])

    return dealt.select("conv_id", "ids", "loss_from", "loss_to").mapInArrow(
        assemble, "conv_id long, position long, ids binary, mask binary")


class Reading:
    """Reads one conversation's segments back from ids and masks alone, segment by segment."""

    def __init__(self, code: Coder):
        self.code, self.turns, self.loss_chars, self.formatted = code, 0, 0, 0
        self.all, self.loss, self.next = hashlib.sha256(), hashlib.sha256(), 0

    def segment(self, position: int, ids: np.ndarray, mask: np.ndarray) -> None:
        if position != self.next or ids[-1] != self.code.first + TURN_END:
            raise ValueError("segments are not gapless turns")
        self.next += len(ids)
        kind, start, role = int(ids[0]) - self.code.first, 1, None
        self.formatted += len(MARKERS[kind]) + len(MARKERS[TURN_END])
        if kind == ROLE:
            start = int(np.flatnonzero(ids == self.code.first + ROLE_END)[0]) + 1
            name = self.code.decode(ids[1:start - 1])
            self.formatted += len(name) + len(MARKERS[ROLE_END])
            role = unescape(name)
        else:
            role = next(r for r, k in _KNOWN.items() if k == kind)
        body = self.code.decode(ids[start:-1])
        self.formatted += len(body)
        self.turns += 1
        self.all.update(f"{role}\n{unescape(body)}\n".encode())
        if mask.any():
            under = unescape(self.code.decode(ids[mask.astype(bool)]))
            self.loss_chars += len(under)
            self.loss.update(under.encode())

    def row(self, conv_id):
        return (conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted, self.next)


def read_back(formatted: DataFrame, params: Params = Params()) -> DataFrame:
    """Digest per conversation, decoded from the ids and masks of `format_conversations`."""
    types = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_ids", pa.int64())]

    def run(batches):
        code = coder(params.vocabulary)
        last, reading = None, None

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)],
                                              names=[n for n, _ in types])

        for batch in batches:
            done = []
            for conv, position, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "ids", "mask"))):
                if (conv,) != last:
                    if last is not None:
                        done.append(reading.row(last[0]))
                    last, reading = (conv,), Reading(code)
                reading.segment(position, np.frombuffer(ids, "<i4"), np.frombuffer(mask, np.uint8))
            if done:
                yield batch_of(done)
        if last is not None:
            yield batch_of([reading.row(last[0])])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long, n_ids long")
