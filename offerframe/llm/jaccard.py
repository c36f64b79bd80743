"""N-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct 5-word shingles.  Every shingle belongs to
one of `groups` hash groups; the counts per group are the document's point.
No pair can share more shingles than the sum over the groups of the smaller
count, and no pair of boxes more than the sum of the smaller upper bounds, so
an R-tree over the points discards most pairs unseen and loses none.  What
survives is verified on the whole texts.

Who has to be compared at all is found by an exact prefix filter: under one
order of all shingles (rare first), two sets with Jaccard >= t share one of
their first n - ceil(t n) + 1 shingles.  The order's frequencies come from a
count sketch over all documents; it steers the work only, any order is exact.

1. One scan makes the sketch, and per document its size, point and set
   signature.  A second scan takes each set's prefix.  A task links its own
   documents of equal prefix shingle to the smallest of them, and only that
   one goes on, so a shingle found everywhere is shuffled once per task.
2. These star links are filtered by size and point, verified, and joined to
   components.  A group of near copies thus costs its members, not its pairs.
3. Prefix shingles whose documents are not all in one component yet are worked
   off in blocks: equal shingle and size class, and in parts of at most `block`
   rows and `block_shingles` shingles against each other where a block is
   larger.  In a block an R-tree self-join over coarse points (sums of
   neighbouring groups, a bound as well) finds the pairs of different components,
   the full points sift them, and a pair that shares several blocks counts in
   the first of them.  No pair leaves the task: the block names, for each
   document that is in a pair, the group of documents its pairs connect it to.
4. Groups of the same documents are worked off once.  Their whole texts meet, the
   R-tree yields the pairs again, their sets are compared on the spot, and
   documents united by a link are not compared any more.  What leaves the task is
   a spanning forest of verified links, fewer rows than documents.  They complete
   the components: every linked pair has been either joined or compared,
   whatever the size of a block.

Defined results: a document without words (or NULL text) has an empty set and
links with nothing; with fewer words than a shingle, the whole sequence is its
one shingle.  A doc_id that repeats is one document with several texts; NULL
ids link with nothing.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bloom
from . import textvec as tv
from .common import id_text, lean, release_shuffles, text_slices, written
from .components import components, local_components


@dataclass(frozen=True)
class Params:
    width: int = 5           # words of a shingle
    percent: int = 80        # Jaccard threshold, in hundredths
    groups: int = 256        # coordinates of a point
    fine: int = 2048         # coordinates of the fine point of a set of more than 2 * groups shingles
    boxes: int = 64          # coordinates of the R-tree's boxes: sums of groups / boxes neighbouring groups
    sketch_bits: int = 20    # counters of the frequency sketch: at least 2**bits, ...
    counter_bytes: int = 48  # ... one for so many bytes of text ...
    most_bits: int = 28      # ... and at most 2**bits (128 MB as classes)
    held_keys: int = 2_000_000  # prefix shingles a task holds before it passes them on
    block: int = 4096        # documents compared at once ...
    block_shingles: int = 500_000  # ... and their shingles, if there is more than one document
    marks: int = 23          # documents in question are marked in a table of at least 2**marks bits, ...
    mark_bits: int = 16      # ... so many for every document ...
    most_marks: int = 30     # ... and at most 2**bits
    listed: int = 16         # pairs of larger blocks are reported by one block only
    leaf: int = 32           # points of an R-tree leaf


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Sorted distinct 64-bit shingle hashes of each text of a slice (A-Z lower-cased)."""
    data = tv.LOWER[data]
    starts, ends, first = tv.word_spans(data, offsets)
    hashes, begin = tv.shingle_hashes(tv.ByteHash(data).of(starts, ends), first, width)
    for i in range(len(offsets) - 1):
        yield np.unique(hashes[begin[i]:begin[i + 1]])


def point_of(s: np.ndarray, groups: int) -> np.ndarray:
    return np.minimum(np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def needed(a, b, percent: int):
    """Shared shingles that sets of a and b shingles need at least, times 100 + percent."""
    return percent * (a + b)


# --- scan 1: sketch, sizes, points, signatures ------------------------------------------

_SCAN = "kind int, doc_id long, n long, sig1 long, sig2 long, point binary, fine binary, part int, counts binary"
_SCAN_TYPES = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sig1", pa.int64()),
                         ("sig2", pa.int64()), ("point", pa.binary()), ("fine", pa.binary()), ("part", pa.int32()),
                         ("counts", pa.binary())])
_SKETCH_PART = 1 << 16  # counters of one sketch row


def sketch_size(text_bytes: int, p: Params) -> int:
    """Counters of the sketch: as many for each shingle whatever the corpus, or else rare shingles of a larger one can no
    longer be told from frequent ones, and more documents meet in their prefixes."""
    return min(max(1 << p.sketch_bits, text_bytes // p.counter_bytes), 1 << p.most_bits)


def _counter(s: np.ndarray, size: int) -> np.ndarray:
    """The counter of each shingle, by its upper half."""
    return ((s >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int32)


def _scan(p: Params, size: int):
    def run(batches):
        waiting, held = [], 0

        def flush():
            parts = [(1, *[None] * 6, k, raw) for k, raw in _packed(*np.unique(np.concatenate(waiting), return_counts=True))]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*parts), _SCAN_TYPES)], schema=_SCAN_TYPES)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, _, data, offs in text_slices(batch.column("text")):
                rows = []
                for k, s in enumerate(shingle_sets(data, offs, p.width)):
                    with np.errstate(over="ignore"):
                        sig = np.array([s.sum(dtype=np.uint64), tv.mix(s).sum(dtype=np.uint64)], np.uint64).view(np.int64)
                    rows.append((ids[a + k], len(s), int(sig[0]), int(sig[1]), point_of(s, p.groups).tobytes(),
                                 point_of(s, p.fine).tobytes() if len(s) > 2 * p.groups else None))
                    waiting.append(_counter(s, size))
                    held += len(s)
                columns = list(zip(*rows))
                none = [None] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip([[0] * len(rows), *columns, none, none], _SCAN_TYPES)],
                    schema=_SCAN_TYPES)
                if held > 4_000_000:
                    yield from flush()
                    waiting, held = [], 0
        if held:
            yield from flush()

    return run


def _used(table: np.ndarray):
    """The parts of `table` with counters that are not zero, as (part, bytes)."""
    used = np.flatnonzero(table)
    return _packed(used, table[used])


def _packed(at: np.ndarray, counts: np.ndarray):
    """Counters at ascending places `at`, as (part, bytes): a task sends what it has counted, not the whole table.

    Few go by place (two bytes) and value (four).  Where that is more, the gaps between places (two planes of bytes) and
    the values (one byte, four more where it is full) are compressed: about a byte each, however large the table."""
    part = at // _SKETCH_PART
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(at)]])
    for f, t in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if t == f:
            continue
        own, values = at[f:t] - part[f] * _SKETCH_PART, counts[f:t] - 1
        gaps = np.diff(own, prepend=0)
        low = np.minimum(values, 255)
        body = b"".join(x.astype(kind).tobytes() for x, kind in
                        ((gaps & 255, "u1"), (gaps >> 8, "u1"), (low, "u1"), (values[low == 255] - 255, "<u4")))
        made = pa.compress(body, "zstd", asbytes=True)
        if len(made) + 8 < 6 * len(own):
            pad = (len(made) + 8) % 6 == 0  # other lengths than those of pairs of two and four bytes
            yield int(part[f]), np.array([len(own), len(body)], "<u4").tobytes()[:7] + bytes([pad] * (1 + pad)) + made
        else:
            yield int(part[f]), own.astype("<u2").tobytes() + counts[f:t].astype("<u4").tobytes()


def _add_used(total: np.ndarray, counts: bytes) -> None:
    """Add the counters of a part that `_packed` gave."""
    if len(counts) % 6 == 0:
        n = len(counts) // 6
        total[np.frombuffer(counts, "<u2", n)] += np.frombuffer(counts, "<u4", n, 2 * n)
        return
    n, size = np.frombuffer(counts[:7] + b"\0", "<u4").tolist()
    body = pa.decompress(counts[8 + counts[7]:], size, "zstd", asbytes=True)
    gaps = np.frombuffer(body, "u1", n).astype(np.int64) | np.frombuffer(body, "u1", n, n).astype(np.int64) << 8
    values = np.frombuffer(body, "u1", n, 2 * n).astype(np.int64)
    values[values == 255] += np.frombuffer(body, "<u4", -1, 3 * n)
    total[np.cumsum(gaps)] += values + 1


def _classes(counts: np.ndarray) -> bytes:
    """Binary logarithm of every counter, 15 at most, two to a byte."""
    c = np.minimum(np.log2(counts + 1), 15).astype(np.uint8)
    return (c[::2] | c[1::2] << 4).tobytes()


def _bits(counts: np.ndarray) -> bytes:
    return np.packbits(counts > 0).tobytes()


def _merged(finish):
    """Rows (part, counts) of all tasks -> one row per part: `finish` of its counters."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                _add_used(total.setdefault(part, np.zeros(_SKETCH_PART, np.int64)), counts)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([finish(v) for v in total.values()], pa.binary())],
                                         names=["part", "counts"])

    return run


def _summed(rows: DataFrame, size: int, finish) -> np.ndarray:
    """The table of `size` counters that rows (part, counts) of all tasks add up to: the bytes that `finish` makes of it."""
    each = len(finish(np.zeros(_SKETCH_PART, np.int64)))
    parts = -(-size // _SKETCH_PART)
    out = np.zeros(parts * each, np.uint8)
    sums = rows.repartition(min(32, parts), "part").mapInArrow(lean(_merged(finish)), "part int, counts binary")
    for r in sums.toLocalIterator():
        out[r["part"] * each:(r["part"] + 1) * each] = np.frombuffer(r["counts"], np.uint8)
    return out


def frequency_classes(scanned: DataFrame, size: int) -> np.ndarray:
    """Classes of all counters of the sketch, half a byte each."""
    return _summed(scanned.where("kind = 1").select("part", "counts"), size, _classes)


# --- scan 2: prefixes and star links ----------------------------------------------------

_KEYED = "key long, a long, b long"
_KEYED_TYPES = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _keyed(key, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                      schema=_KEYED_TYPES)


def _prefixes(p: Params, classes, counters: int):
    """Rows (key, document, NULL) for the smallest document per key, (key, document, smallest) for the others."""
    def run(batches):
        table = classes.value
        keys, docs, held = [], [], 0

        def flush():
            key, doc = np.concatenate(keys).view(np.int64), np.concatenate(docs)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            low = doc[new][np.cumsum(new) - 1]
            other = ~new & (doc != low)
            for at in range(0, len(key), 200_000):
                part = slice(at, at + 200_000)
                n, o = new[part], other[part]
                if n.any():
                    yield pa.RecordBatch.from_arrays([pa.array(key[part][n]), pa.array(doc[part][n]),
                                                      pa.nulls(int(n.sum()), pa.int64())], schema=_KEYED_TYPES)
                if o.any():
                    yield _keyed(key[part][o], doc[part][o], low[part][o])

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for a, _, data, offs in text_slices(batch.column("text")):
                for k, s in enumerate(shingle_sets(data, offs, p.width)):
                    if len(s):
                        at = _counter(s, counters)
                        rank = (table[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15).astype(np.uint64)
                        order = rank << np.uint64(57) | s >> np.uint64(7)
                        size = len(s) + (-p.percent * len(s) // 100) + 1
                        keys.append(np.partition(order, size - 1)[:size])
                        docs.append(np.full(size, ids[a + k], np.int64))
                        held += size
                if held > p.held_keys:
                    yield from flush()
                    keys, docs, held = [], [], 0
        if held:
            yield from flush()

    return run


def _stars(batches):
    """Sorted (key, document) rows -> (key, document, smallest document of the key); links pass through."""
    last_key, low = None, None
    for batch in batches:
        link = batch.column("b").is_valid()
        passed = batch.filter(link)
        if passed.num_rows:
            yield passed
        batch = batch.filter(pc.invert(link))
        key, doc = batch.column("key").to_numpy(), batch.column("a").to_numpy()
        if not len(key):
            continue
        new = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
        lows = np.concatenate([[-1 if low is None else low], doc[new]])[np.cumsum(new)]
        last_key, low = key[-1], lows[-1]
        other = lows != doc
        if other.any():
            yield _keyed(key[other], doc[other], lows[other])


# --- documents in question --------------------------------------------------------------

def _slots(ids: np.ndarray, p: Params) -> np.ndarray:
    return (tv.mix(ids.view(np.uint64)) >> np.uint64(64 - p.marks)).astype(np.int64)


def marked(ids: DataFrame, p: Params):
    """A broadcast table of bits in which every document of the columns of `ids` has its bit
    set: 2**marks bits.  It only keeps other documents'
    texts and points out of the joins that follow; some may pass."""
    def run(batches):
        slots = [np.zeros(0, np.int64)]
        for batch in batches:
            slots += [_slots(batch.column(c).to_numpy(), p) for c in batch.schema.names]
        slots = np.unique(np.concatenate(slots))
        parts = list(_packed(slots, np.ones(len(slots), np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()),
                                          pa.array([r for _, r in parts], pa.binary())], names=["part", "counts"])

    bits = _summed(ids.mapInArrow(lean(run), "part int, counts binary"), 1 << p.marks, _bits)
    return ids.sparkSession.sparkContext.broadcast(bits)


def only_marked(df: DataFrame, marks, p: Params) -> DataFrame:
    """The rows of `df` whose doc_id has its bit set (rows without an id go)."""
    def run(batches):
        bits = marks.value
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            slot = _slots(batch.column("doc_id").to_numpy(), p)
            yield batch.filter(pa.array((bits[slot >> 3] >> (7 - (slot & 7)) & 1).astype(bool)))

    return df.mapInArrow(lean(run), df.schema)


# --- comparing --------------------------------------------------------------------------

_FULL = 255         # a counter at its limit ...
_UNBOUNDED = 1 << 24  # ... counts as any number


def points(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Most shingles that row i of x and row i of y can share: summed coordinate minima."""
    least = np.minimum(x, y)
    return least.sum(1, dtype=np.int64) + (least == _FULL).any(1) * _UNBOUNDED


def coarse(x: np.ndarray, boxes: int) -> np.ndarray:
    """Points with fewer coordinates: a coordinate is the sum of neighbouring ones."""
    parts = x.reshape(len(x), boxes, -1)
    return parts.sum(2, dtype=np.int32) + (parts == _FULL).any(2) * np.int32(_UNBOUNDED)


class RTree:
    """Static R-tree over points: rows are split at the median of the widest
    coordinate; a node keeps its upper corner and its smallest and largest set size."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, n: np.ndarray, leaf: int):
        self.rows, self.low, self.high = rows, int(n[rows].min()), int(n[rows].max())
        self.top = x[rows].max(0)
        self.children: tuple = ()
        if len(rows) > leaf:
            widest = int(np.argmax(np.ptp(x[rows], 0)))
            order = rows[np.argsort(x[rows, widest], kind="stable")]
            half = len(order) // 2
            self.children = (RTree(order[:half], x, n, leaf), RTree(order[half:], x, n, leaf))


def tree_pairs(full: np.ndarray, n: np.ndarray, comp: np.ndarray, p: Params, left: np.ndarray, right: np.ndarray):
    """Pairs (i, j), i of `left` and j of `right`, of different components whose sizes and points allow a link."""
    if not len(left) or not len(right):
        return
    same = left is right
    x = coarse(full, p.boxes)
    a = RTree(left, x, n, p.leaf)
    stack = [(a, a if same else RTree(right, x, n, p.leaf))]
    factor = 100 + p.percent
    while stack:
        u, v = stack.pop()
        if 100 * u.high < p.percent * v.low or 100 * v.high < p.percent * u.low:
            continue
        if factor * int(np.minimum(u.top, v.top).sum(dtype=np.int64)) < needed(u.low, v.low, p.percent):
            continue
        if u.children or v.children:
            if u is v:
                one, two = u.children
                stack += [(one, one), (two, two), (one, two)]
            elif u.children and (not v.children or len(u.rows) >= len(v.rows)):
                stack += [(c, v) for c in u.children]
            else:
                stack += [(u, c) for c in v.children]
            continue
        i, j = u.rows, v.rows
        fits = comp[i][:, None] != comp[j][None, :]
        fits &= 100 * np.minimum(n[i][:, None], n[j][None, :]) >= p.percent * np.maximum(n[i][:, None], n[j][None, :])
        if not fits.any():
            continue
        shared = np.minimum(x[i][:, None, :], x[j][None, :, :]).sum(-1, dtype=np.int64)
        fits &= factor * shared >= needed(n[i][:, None], n[j][None, :], p.percent)
        at, to = np.nonzero(np.triu(fits, 1) if u is v else fits)
        at, to = i[at], j[to]
        keep = factor * bound(full[at], full[to]) >= needed(n[at], n[to], p.percent)
        yield at[keep], to[keep]


_GROUPED = "team long, doc_id long, comp long"
_GROUPED_TYPES = pa.schema([("team", pa.int64()), ("doc_id", pa.int64()), ("comp", pa.int64())])


def _runs(batches, column: str, load):
    """The rows of each value of a sorted column, as lists of what `load` takes from a batch."""
    held, last = [], None
    for batch in batches:
        own = batch.column(column).to_numpy()
        cols = load(batch)
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
        for f, t in zip(cuts[:-1], cuts[1:]):
            if t > f:
                if held and own[f] != last:
                    yield last, held
                    held = []
                held.append([c[f:t] for c in cols])
                last = own[f]
    if held:
        yield last, held


def _teamed(name: int, i, j, doc, comp):
    """(team, doc_id, comp) of the documents that the pairs (i, j) found in block or team `name` connect."""
    at, low = local_components(i, j)
    with np.errstate(over="ignore"):
        team = tv.mix(np.uint64(np.int64(name)) ^ tv.mix(low.astype(np.uint64))).view(np.int64)
    return team, doc[at], comp[at]


def _block_groups(p: Params):
    """Rows of whole blocks, sorted by block -> for each document in a pair that the bound leaves, the team of
    documents that such pairs connect it to.

    side 0 and 1 of a block are compared with each other, side 0 also with itself when `own`."""

    def solve(block, rows):
        doc, n, comp, side, own, key, x = (np.concatenate([r[k] for r in rows]) for k in range(7))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = list(tree_pairs(x, n, comp, p, left, right))
        if own[0]:
            found += list(tree_pairs(x, n, comp, p, left, left))
        if not found:
            return
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        keys = [k for r in rows for k in r[7]]
        if keys[0]:  # a block of listed shingles, each with the document's smaller ones: the pair counts in the smallest common one
            keys = {k: frozenset(keys[k]) for k in set(i.tolist()) | set(j.tolist())}
            first = np.array([min(keys[a] & keys[b]) == key[0] for a, b in zip(i.tolist(), j.tolist())], bool)
            i, j = i[first], j[first]
        if len(i):
            yield _teamed(block, i, j, doc, comp)

    def load(batch):
        return ([batch.column(c).to_numpy() for c in ("doc_id", "n", "comp", "side", "own", "key")]
                + [points(batch.column("point")), batch.column("keys").to_pylist()])

    def run(batches):
        for block, rows in _runs(batches, "block", load):
            for found in solve(block, rows):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=_GROUPED_TYPES)

    return run


def linked_pairs(sets: list[np.ndarray], comp: np.ndarray, p: Params):
    """Links (i, j) between sets of different components: enough of them to connect all that are linked."""
    n = np.array([len(s) for s in sets], np.int64)
    every, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(n)
    own = [codes[e - k:e] for k, e in zip(n, ends)]
    full = np.stack([point_of(s, p.groups) for s in sets])
    _, start = np.unique(comp, return_inverse=True)
    root = np.arange(start.max() + 1)  # of each component, the one it is united with
    here = np.zeros(len(every), bool)
    some = np.flatnonzero(n > 0)
    for left, right in tree_pairs(full, n, comp, p, some, some):
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
        cuts = np.concatenate([[0], np.flatnonzero(left[1:] != left[:-1]) + 1, [len(left)]])
        for f, t in zip(cuts[:-1], cuts[1:]):
            if t == f:
                continue
            i, js = left[f], right[f:t]
            js = js[root[start[js]] != root[start[i]]]
            if not len(js):
                continue
            here[own[i]] = True
            shared = np.add.reduceat(here[np.concatenate([own[j] for j in js])], np.cumsum(n[js]) - n[js], dtype=np.int64)
            here[own[i]] = False
            for j in js[100 * shared >= p.percent * (n[i] + n[js] - shared)].tolist():
                a, b = root[start[i]], root[start[j]]
                if a != b:
                    root[root == b] = a
                    yield i, j


def _team_links(p: Params):
    """Rows of whole teams (team, doc_id, comp, text), sorted by team -> verified links."""
    def load(batch):
        sets = []
        for _, _, data, offs in text_slices(batch.column("text")):
            sets += list(shingle_sets(data, offs, p.width))
        return [batch.column("doc_id").to_numpy(), batch.column("comp").to_numpy(), sets]

    def run(batches):
        for _, rows in _runs(batches, "team", load):
            doc, comp = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
            sets = [s for r in rows for s in r[2]]
            links = list(linked_pairs(sets, comp, p))
            if links:
                i, j = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(doc[i], doc[j])), pa.array(np.minimum(doc[i], doc[j]))],
                                                 names=["a", "b"])

    return run


def _sift(p: Params):
    """Rows of whole teams (team, doc_id, comp, n, fine), sorted by team -> the teams that fine points leave of them.

    A set without a fine point is bounded by the other's size alone."""
    unknown = bytes([_FULL]) * p.fine

    def load(batch):
        fine = [f or unknown for f in batch.column("fine").to_pylist()]
        return ([batch.column(c).to_numpy() for c in ("doc_id", "n", "comp")]
                + [np.frombuffer(b"".join(fine), np.uint8).reshape(len(fine), -1)])

    def run(batches):
        for team, rows in _runs(batches, "team", load):
            doc, n, comp, x = (np.concatenate([r[k] for r in rows]) for k in range(4))
            every = np.arange(len(doc))
            found = list(tree_pairs(x, n, comp, p, every, every))
            i, j = (np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k in (0, 1))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _teamed(team, i, j, doc, comp)], schema=_GROUPED_TYPES)

    return run


def sifted(teams: DataFrame, scanned: DataFrame, p: Params) -> DataFrame:
    """The teams (team, doc_id, comp) without the documents that fine points rule out: texts of the others alone meet.

    Points of few coordinates bound nothing where sets are large: two unrelated sets fill them alike."""
    teams = _once(teams)
    fine = only_marked(scanned.select("doc_id", "n", "fine"), marked(teams.select("doc_id"), p), p)
    return (teams.join(fine, "doc_id").select("team", "doc_id", "comp", "n", "fine").repartition("team")
            .sortWithinPartitions("team").mapInArrow(lean(_sift(p)), _GROUPED).dropDuplicates(["team", "doc_id"]))


def _once(teams: DataFrame) -> DataFrame:
    """Of teams of the same documents, one."""
    alike = teams.groupBy("team").agg(F.count(F.lit(1)).alias("docs"), F.bit_xor(F.xxhash64("doc_id")).alias("x1"),
                                      F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("x2"))
    return teams.join(alike.groupBy("docs", "x1", "x2").agg(F.min("team").alias("team")).select("team"), "team", "left_semi")


def team_links(teams: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Verified links inside the teams (team, doc_id, comp), teams of the same documents worked off once."""
    teams = _once(teams)
    texts = only_marked(docs, marked(teams.select("doc_id"), p), p)
    return (teams.join(texts, "doc_id").select("team", "doc_id", "comp", "text").repartition("team")
            .sortWithinPartitions("team").mapInArrow(lean(_team_links(p)), "a long, b long"))


def _verify(p: Params):
    def run(batches):
        for batch in batches:
            sets = []
            for c in ("text_a", "text_b"):
                own = []
                for _, _, data, offs in text_slices(batch.column(c)):
                    own += list(shingle_sets(data, offs, p.width))
                sets.append(own)
            keep = []
            for x, y in zip(*sets):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(shared) and 100 * shared >= p.percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the threshold."""
    docs = only_marked(docs, marked(pairs.select("a", "b"), p), p)
    text = lambda c: docs.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lean(_verify(p)), "a long, b long")


def _possible(pairs: DataFrame, sizes: DataFrame, p: Params) -> DataFrame:
    """Pairs with sizes, points and signatures, without those that sizes or points rule out."""
    sizes = only_marked(sizes, marked(pairs.select("a", "b"), p), p)
    side = lambda c: sizes.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig1").alias(f"s1_{c}"),
                                  F.col("sig2").alias(f"s2_{c}"), F.col("point").alias(f"p_{c}"))
    fits = (100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b")) & (F.col("n_a") > 0)
    factor = 100 + p.percent

    def run(batches):
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = pa.array(factor * bound(points(batch.column("p_a")), points(batch.column("p_b"))) >= p.percent * n)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "equal")],
                                             names=["a", "b", "equal"])

    return (pairs.join(side("a"), "a").join(side("b"), "b").where(fits)
            .select("a", "b", ((F.col("s1_a") == F.col("s1_b")) & (F.col("s2_a") == F.col("s2_b"))
                               & (F.col("n_a") == F.col("n_b"))).alias("equal"), "n_a", "n_b", "p_a", "p_b")
            .mapInArrow(lean(run), "a long, b long, equal boolean"))


def _links(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Verified links among `pairs`; sets with equal 128-bit signatures are equal."""
    possible = written(_possible(pairs, sizes, p), "possible")
    release_shuffles(docs.sparkSession)
    open_pairs = possible.where("NOT equal").select("a", "b")
    return written(possible.where("equal").select("a", "b").unionByName(verified(open_pairs, docs, p)), "links")


def _blocks(members: DataFrame, p: Params) -> DataFrame:
    """(key, listed, doc_id, n, texts, comp) -> rows of blocks to compare; `texts` of a document are of size n.

    A document belongs to the size class of its n (steps of 100 / percent) and
    visits the next class, whose members may be that much larger.  A block over
    `block` rows or `block_shingles` is dealt into parts; every two parts meet in a block of their own.
    """
    step = float(np.log(100.0 / p.percent))
    classed = members.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + F.lit(1e-9)))
    both = F.explode(F.array(F.struct(F.col("class").alias("class"), F.lit(0).alias("side")),
                             F.struct((F.col("class") + 1).alias("class"), F.lit(1).alias("side"))))
    rows = classed.withColumn("at", both).select("key", "listed", "doc_id", "n", "texts", "comp", "at.class", "at.side")
    sizes = (rows.groupBy("key", "class").agg(F.sum("texts").alias("rows"), F.sum(1 - F.col("side")).alias("home"), F.min("comp").alias("c1"),
                                              F.max("comp").alias("c2"), F.sum(F.col("n") * F.col("texts")).alias("shingles"))
             .where((F.col("home") > 0) & (F.col("c1") != F.col("c2")))
             .select("key", "class", F.greatest(F.ceil(F.col("rows") / F.lit(p.block)), F.least("rows", F.ceil(
                 F.col("shingles") / F.lit(p.block_shingles)))).cast("int").alias("parts")))
    rows = rows.join(sizes, ["key", "class"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    # Part i meets part j >= i in block (i, j): a row is in `parts` blocks.
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least("part", k).alias("i"), F.greatest("part", k).alias("j"))))
    rows = rows.withColumn("meet", meets)
    # Inside a part: home rows (side 0) with one another and with visitors (side 1).  Between two parts:
    # everything of part i against everything of part j; pairs of two visitors meet in their own class too.
    across = F.col("meet.i") != F.col("meet.j")
    return rows.select(
        F.xxhash64("key", "class", "meet.i", "meet.j").alias("block"), "doc_id", "n", "comp",
        F.when(across, (F.col("part") == F.col("meet.j")).cast("int")).otherwise(F.col("side")).alias("side"),
        (~across).cast("int").alias("own"), "key", "listed")


def near_duplicates(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs`."""
    p = params
    every = id_text(docs, id_col, text_col)
    known = every.where("doc_id IS NOT NULL")
    size = sketch_size(every.agg(F.sum(F.octet_length("text"))).first()[0] or 0, p)
    scanned = written(every.mapInArrow(lean(_scan(p, size)), _SCAN), "shingles")
    sizes = scanned.where("kind = 0").select("doc_id", "n", "sig1", "sig2", "point")
    p = replace(p, marks=min(max(p.marks, (p.mark_bits * sizes.count()).bit_length()), max(p.marks, p.most_marks)))
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(scanned, size))
    # The smallest documents of a key meet in one partition; links found already pass through, spread evenly.
    spread = F.when(F.col("b").isNull(), F.lit(0)).otherwise(F.xxhash64("a"))
    stars = (known.mapInArrow(lean(_prefixes(p, classes, size)), _KEYED).repartition("key", spread)
             .sortWithinPartitions("key", "a").mapInArrow(lean(_stars), _KEYED))
    stars = written(stars, "stars")
    first = written(stars.select("a", "b").distinct(), "pairs")
    release_shuffles(docs.sparkSession)
    links = _links(first, sizes, known, p)
    groups = written(components(links), "components")
    release_shuffles(docs.sparkSession)

    # Shingles whose documents are not all in one component.
    member = lambda c: groups.select(F.col("id").alias(c), F.col("component_id").alias(f"comp_{c}"))
    apart = (first.join(member("a"), "a", "left").join(member("b"), "b", "left")
             .where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b"))
    mixed = stars.join(apart, ["a", "b"], "left_semi").select("key").distinct()
    rows = stars.join(mixed, "key", "left_semi")
    rows = written(rows.select("key", F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "mixed")
    release_shuffles(docs.sparkSession)
    # Two documents have met in step 2; and of shingles with the same documents one is enough.
    alike = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.bit_xor(F.xxhash64("doc_id")).alias("x1"),
                                     F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("x2")).where("docs > 2"))
    rows = written(rows.join(alike.groupBy("docs", "x1", "x2").agg(F.min("key").alias("key")).select("key", "docs"), "key"),
                   "blocks")
    # A document's own larger shingles, few of its prefix.
    lists = rows.where(F.col("docs") > p.listed).groupBy("doc_id").agg(F.collect_list("key").alias("all"))
    asked = only_marked(sizes, marked(rows.select("doc_id"), p), p).where("n > 0")
    rows = (rows.select("key", "doc_id", (F.col("docs") > p.listed).alias("listed"))
            .join(asked.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("texts")), "doc_id")
            .join(groups.select(F.col("id").alias("doc_id"), F.col("component_id").alias("comp")), "doc_id", "left")
            .withColumn("comp", F.coalesce("comp", "doc_id")))
    # Blocks are found with narrow rows; points, and the listed shingles up to the block's own, join those that are left.
    rows = written(_blocks(rows, p), "rows")
    release_shuffles(docs.sparkSession)
    blocks = (rows.join(asked.select("doc_id", "n", "point"), ["doc_id", "n"]).join(lists, "doc_id", "left")
              .select("block", "doc_id", "n", "comp", "side", "own", "point", "key",
                      F.when(F.col("listed"), F.filter("all", lambda k: k <= F.col("key"))).alias("keys"))
              .repartition("block").sortWithinPartitions("block"))
    teams = written(blocks.mapInArrow(lean(_block_groups(p)), _GROUPED).dropDuplicates(["team", "doc_id"]), "teams")
    del blocks, rows, lists, alike
    release_shuffles(docs.sparkSession)
    teams = written(sifted(teams, scanned.where("kind = 0"), p), "sifted")
    release_shuffles(docs.sparkSession)
    # Written before the next step in Python: two such steps in one stage would need twice the workers.
    more = written(team_links(teams, known, p), "links")
    release_shuffles(docs.sparkSession)
    final = components(groups.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(more))
    return (sizes.select("doc_id", F.col("n").alias("n_shingles"))
            .join(final.select(F.col("id").alias("doc_id"), "component_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def near_dedup(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, of which one document per component stays (rows with NULL ids stay).

    Texts stay where they lie: a Bloom filter over the ids that go is sent to the scan, and only rows that it
    lets pass are shuffled for the exact join."""
    release_shuffles(docs.sparkSession)  # of whatever made `docs`
    gone = (near_duplicates(docs, params, id_col, text_col).where("component_id <> doc_id")
            .select(F.col("doc_id").alias(id_col)).distinct())
    gone = written(gone, "gone")
    release_shuffles(docs.sparkSession)
    blocks = bloom.blocks_for(gone.count())
    keyed = docs.withColumn("_id", F.col(id_col).cast("long"))
    asked, rest = bloom.split(keyed, ["_id"], bloom.build(gone, [id_col], blocks), blocks)
    return rest.unionByName(asked.join(gone, id_col, "left_anti")).select(*docs.columns)
