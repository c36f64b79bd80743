"""Exact dedup by Patricia tries.

Equal texts are found by inserting their full byte strings into compressed
radix tries: two texts are equal when they end at the same terminal node, so
no hash decides equality.  A terminal node stores the smallest identifier
under the keeping order (here: most code points of the original text, then
smallest id, then first row).

1. The 64-bit hashes of all texts tell which texts may have an equal one: a
   hash that occurs once belongs to a text that occurs once.  Those that occur
   more often go into a Bloom filter.
2. Every task inserts its own rows into a trie of bounded size.  Copies inside
   the task meet at one terminal node; per node only one representative with
   the text's bytes, its best owner and its count goes on.  A group of copies
   holding a third of all rows thus shrinks to one row per task (or per trie,
   when the bound is reached) before anything is shuffled.  A representative
   whose hash the filter does not let pass is its group alone and needs no text.
3. The other representatives are dealt out by text length and content hash and inserted
   into the tries of their partition.  A trie over its memory bound spills by
   subtree: the largest first-level subtree goes to a temporary file of the
   task, later strings of that subtree follow it, and the file is worked off
   with a trie of its own, split at its strings' next differing byte.
4. Every row gets its group's owner by an equi-join on the representative.

Defined results: NULL text counts as empty, empty texts are equal; ids may be
NULL (sorted last) or repeat, of fully equal rows the first one stays; columns
other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bloom
from .common import lean, release_shuffles, written

WHOLE_TEXTS = {"compression": "zstd"}  # of files that hold whole texts

SPACES = bytes([0x20, *range(0x09, 0x0E)])
_NODE_BYTES = 400  # what a node costs besides its label


@dataclass(frozen=True)
class Params:
    map_bytes: int = 48 << 20    # trie of a reading task: flushed when larger
    trie_bytes: int = 96 << 20   # trie of a partition: spills subtrees when larger


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACES)


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, None, value


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of `label` and key[at:]."""
    if key.startswith(label, at):
        return len(label)
    n = min(len(label), len(key) - at)
    a = np.frombuffer(label, np.uint8, n)
    b = np.frombuffer(key, np.uint8, n, at)
    differs = np.flatnonzero(a != b)
    return int(differs[0]) if len(differs) else n


class Trie:
    """Compressed radix trie over byte strings; `nbytes` estimates its memory."""

    def __init__(self):
        self.root = Node(b"")
        self.nbytes = 0
        self.weights: dict[int, int] = {}  # bytes below each first-level child

    def terminal(self, key: bytes) -> Node:
        """The node at which `key` ends, made if missing (its value is then None)."""
        node, at, added = self.root, 0, 0
        while at < len(key):
            if node.children is None:
                node.children = {}
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                added += _NODE_BYTES + len(child.label)
                node, at = child, len(key)
                continue
            n = _common(child.label, key, at)
            if n < len(child.label):  # split the edge where the strings part
                middle = Node(child.label[:n])
                child.label = child.label[n:]
                middle.children = {child.label[0]: child}
                node.children[key[at]] = middle
                added += _NODE_BYTES
                child = middle
            node, at = child, at + n
        if added:
            self.nbytes += added
            self.weights[key[0]] = self.weights.get(key[0], 0) + added
        return node

    def values(self, node: Node | None = None, prefix: bytes = b""):
        """(key, value) of every terminal node below `node`."""
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            prefix += node.label
            if node.value is not None:
                yield prefix, node.value
            if node.children:
                stack += [(c, prefix) for c in node.children.values()]

    def cut_largest(self) -> tuple[int, Node] | None:
        """Take out the heaviest first-level subtree."""
        if not self.weights:
            return None
        first = max(self.weights, key=self.weights.get)
        self.nbytes -= self.weights.pop(first)
        return first, self.root.children.pop(first)


def better(x: tuple, y: tuple) -> tuple:
    """The owner that stays; owners are (code points, id or None, row)."""
    rank = lambda o: (-o[0], o[1] is None, o[1] or 0, o[2])
    return x if rank(x) <= rank(y) else y


class Owners:
    """Groups of a partition: merges (key, representative, owner, count) records
    and yields (representatives, owner, count) per distinct key within a memory bound."""

    def __init__(self, limit: int, skip: int = 0):
        self.trie, self.limit, self.skip = Trie(), limit, skip  # the first `skip` bytes are equal in all keys
        self.files: dict[int, object] = {}

    def add(self, key: bytes, reps: list[int], owner: tuple, count: int) -> None:
        rest = key[self.skip:]
        if rest and rest[0] in self.files:
            pickle.dump((key, reps, owner, count), self.files[rest[0]])
            return
        node = self.trie.terminal(rest)
        if node.value is None:
            node.value = [list(reps), owner, count]
        else:
            node.value[0] += reps
            node.value[1] = better(node.value[1], owner)
            node.value[2] += count
        # One lone string cannot be split; with two or more the largest subtree goes to disk.
        while self.trie.nbytes > self.limit and (len(self.trie.weights) > 1 or self._branches()):
            self._spill(key[:self.skip])

    def _branches(self) -> bool:
        children = self.trie.root.children
        return bool(children) and any(c.children for c in children.values())

    def _spill(self, prefix: bytes) -> None:
        first, node = self.trie.cut_largest()
        self.files[first] = file = tempfile.TemporaryFile(prefix="trie-")
        for rest, (reps, owner, count) in self.trie.values(node):
            pickle.dump((prefix + rest, reps, owner, count), file)

    def groups(self):
        for _, (reps, owner, count) in self.trie.values():
            yield reps, owner, count
        self.trie = Trie()
        for file in self.files.values():
            shared = None
            for key, *_ in _records(file):
                shared = key if shared is None else shared[:_common(shared, key, 0)]
            below = Owners(self.limit, len(shared))
            for key, reps, owner, count in _records(file):
                below.add(key, reps, owner, count)
            file.close()
            yield from below.groups()


def _records(file):
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            file.seek(0, os.SEEK_END)
            return


_PART = ("rep long, row long, doc_id long, sha string, n long, points long, best_doc long, best_row long, "
         "length long, hash long, key binary")
_PART_NAMES = [c.split()[0] for c in _PART.split(", ")]
_PART_TYPES = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                         for c in _PART.split(", ")])


def _hash(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "big", signed=True)


def _hashes(batches):
    """The hash of every row's normalised text, NULL counting as empty."""
    for batch in batches:
        text = pc.fill_null(batch.column("text"), "")
        raw = text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary())
        found = [_hash(hashlib.sha256(normalised(t.as_py())).digest()) for t in raw]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["hash"])


def _map_side(params: Params):
    def run(batches):
        trie = Trie()

        def flush():
            out, size = [], 0
            for key, (rep, sha, owner, n) in trie.values():
                out.append((rep, None, None, None, n, *owner, len(key), _hash(sha), key))
                size += len(key)
                if size > 8 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

        for batch in batches:
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            text = pc.fill_null(batch.column("text"), "")
            points = pc.utf8_length(text).to_pylist()
            raw = text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary())
            members = []
            for i, row in enumerate(rows):
                key = normalised(raw[i].as_py())
                node = trie.terminal(key)
                owner = (points[i], ids[i], row)
                if node.value is None:
                    node.value = [row, hashlib.sha256(key).digest(), owner, 1]
                else:
                    node.value[2] = better(node.value[2], owner)
                    node.value[3] += 1
                members.append((node.value[0], row, ids[i], node.value[1].hex(), *[None] * 7))
                if trie.nbytes > params.map_bytes:
                    yield from flush()
                    trie = Trie()
            yield _batch(members)
        yield from flush()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _PART_NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _PART_TYPES)], schema=_PART_TYPES)


def _reduce_side(params: Params):
    def run(batches):
        owners = Owners(params.trie_bytes)
        for batch in batches:
            points, docs, rows = (batch.column(c).to_pylist() for c in ("points", "best_doc", "best_row"))
            reps, counts, keys = (batch.column(c) for c in ("rep", "n", "key"))
            for i in range(batch.num_rows):
                owners.add(keys[i].as_py(), [reps[i].as_py()], (points[i], docs[i], rows[i]), counts[i].as_py())
        out, schema = [], pa.schema([(c, pa.int64()) for c in ("rep", "keep_id", "keep_row", "group_size")])
        for reps, (_, doc, row), n in owners.groups():
            out += [(r, doc, row, n) for r in reps]
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(),
                 row_col: str | None = None) -> DataFrame:
    """One row per input row: row (its number), doc_id, keep_id, group_size, kept, text_sha256.

    `row_col` names a column of unique row numbers; without it rows are numbered here.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    twice = written(rows.select("text").mapInArrow(lean(_hashes), "hash long").groupBy("hash").count().where("count > 1")
                    .select("hash"), "twice")
    blocks = bloom.blocks_for(twice.count())
    parts = bloom.flagged(rows.mapInArrow(lean(_map_side(params)), _PART), ["hash"], bloom.build(twice, ["hash"], blocks),
                          blocks, "may")
    parts = written(parts.select(*_PART_NAMES[:-1], F.when(F.col("may"), F.col("key")).alias("key")), "trie", **WHOLE_TEXTS)
    owners = (parts.where("key IS NOT NULL")
              .select("rep", "n", "points", "best_doc", "best_row", "key", "length", "hash")
              .repartition("length", "hash").drop("length", "hash")
              .mapInArrow(lean(_reduce_side(params)), "rep long, keep_id long, keep_row long, group_size long"))
    alone = parts.where("row IS NULL AND key IS NULL").select(
        "rep", F.col("best_doc").alias("keep_id"), F.col("best_row").alias("keep_row"), F.col("n").alias("group_size"))
    members = parts.where("row IS NOT NULL").select("rep", "row", "doc_id", "sha")
    return (members.join(owners.unionByName(alone), "rep")
            .select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """The rows of `docs`, all columns, of which one per group of equal texts stays.

    The numbered rows are written first: numbers given twice could differ
    (executors come and go, and with them the splits of a scan).  Texts stay where
    they lie: a Bloom filter over the numbers that go is sent to the scan, and only
    rows that it lets pass are shuffled for the exact join.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered", **WHOLE_TEXTS)
    # Every number has its row in the groups, so the rows that stay are those that do not go.
    gone = written(exact_groups(numbered, id_col, text_col, params, number).where("NOT kept").select(F.col("row").alias(number)),
                   "gone")
    release_shuffles(docs.sparkSession)
    return bloom.without(numbered, gone, [number]).drop(number)
