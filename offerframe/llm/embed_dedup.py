"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets 64 random-hyperplane bits, concatenated to one
key, and all vectors are put in the lexicographic order of their keys; each is
compared with the next `window` vectors of that order.  Vectors of cosine c
agree in a bit with probability p = 1 - arccos(c) / pi, and about log2(N /
window) equal leading bits bring them into one window if directions are spread
evenly, so a first number of passes follows from N; it grows with N like
N ** -log2(p) (0.15 for 0.95).

Where vectors crowd, more rows share a prefix and a window reaches less far.
So every pass measures, for every vector, how many leading bits L it shares
with the first vectors outside its window: a neighbour that shares more is
inside, which has a probability of at least p ** (L + 1).  A vector is settled
when the passes so far leave a chance of at most 1 - recall of missing a
neighbour at the threshold.  A pair is at risk only while both its vectors are
unsettled, so only these go on to further passes (twice as many each round),
until none is left or comparing them all with each other, in blocks, costs no
more than the next round.

Verified pairs of all passes are united to components.  Only pairs with a
cosine (in double precision) of the threshold or more are ever joined.

A window bounds whom a vector meets, not who is counted: inside a component
all pairs are compared exactly, in blocks of `block` rows against each other,
and only counts leave a block.  So groups of thousands of near copies get all
their links.  Vectors of equal bytes are collapsed first and counted by their
number.

Blocks of an order are cut by exact rank, with `window` + 1 rows of the blocks
before and after repeated at their ends, so no pair is lost at a cut and a task
holds one block at a time whatever the order's size.

Defined results: vectors that are NULL, zero, empty, or hold NULL or
non-finite components link with nothing; neither do vectors of different
lengths; a vec_id that repeats is one vertex; a NULL vec_id links with nothing.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rank import rank_within
from .common import lean, written
from .components import components, local_components


# One more pass of a row is taken to cost as much as comparing it with this many others.
ROWS_PER_PASS = 1024
# Chances of a miss are added up as logarithms in whole millionths, so that their order does not matter.
UNIT = 1_000_000


@dataclass(frozen=True)
class Params:
    cosine: float = 0.95
    window: int = 32       # following vectors of an order that a vector is compared with
    recall: float = 0.99   # wanted at the threshold, over all passes
    block: int = 2048      # rows compared at once
    seed: int = 5


def passes_for(n: int, p: Params) -> int:
    """Passes of the first round: those after which a pair at the threshold has
    met with probability `recall` if directions are spread evenly."""
    agree = 1 - acos(p.cosine) / pi
    meet = agree ** max(0.0, log2(max(2, n) / p.window))
    return max(2, ceil(log(1 - p.recall) / log(1 - meet))) if meet < 1 else 2


@lru_cache(256)
def planes(seed: int, number: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dim]).normal(size=(dim, 64))


def _usable(kind: str):
    """(vec_id, embedding) -> (vec_id, dim, raw): vectors that can link with others, as bytes."""
    def run(batches):
        for batch in batches:
            ids, dims, raws = [], [], []
            column = batch.column("embedding")
            for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
                cell = column[i]
                if vec_id is None or not cell.is_valid or cell.values.null_count or not len(cell.values):
                    continue
                x = cell.values.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all() and x.any():
                    ids.append(vec_id)
                    dims.append(len(x))
                    raws.append(x.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(raws, pa.binary())], names=["vec_id", "dim", "raw"])

    return run


def unit(raws: list[bytes], kind: str) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = np.frombuffer(b"".join(raws), kind).reshape(len(raws), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _keys(kind: str, numbers: range, seed: int):
    """One row per vector and pass, with the pass's key."""
    def run(batches):
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                for at in range(0, part.num_rows, 4096):
                    some = part.slice(at, 4096)
                    x = unit(some.column("raw").to_pylist(), kind)
                    for number in numbers:
                        bits = (x @ planes(seed, number, dim) > 0).astype(np.uint64)
                        key = ((bits * weights).sum(1, dtype=np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([number] * some.num_rows, pa.int32()), some.column("dim"), pa.array(key),
                             some.column("vec_id"), some.column("raw")], names=["number", "dim", "key", "vec_id", "raw"])

    return run


def _by_block(batches, columns):
    """Rows of sorted batches, one block at a time, as lists of the columns."""
    held, last = None, None
    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
        cols = [batch.column(c).to_pylist() for c in columns]
        for f, t in zip(cuts[:-1], cuts[1:]):
            if t == f:
                continue
            if held is not None and block[f] == last:
                for h, c in zip(held, cols):
                    h += c[f:t]
            else:
                if held is not None:
                    yield held
                held, last = [c[f:t] for c in cols], block[f]
    if held is not None:
        yield held


def equal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that keys share."""
    x = (a ^ b).view(np.uint64)
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return 64 - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def sureness(keys: np.ndarray, p: Params) -> np.ndarray:
    """-log of the chance that a vector misses a neighbour at the threshold in this
    order, at most, in units; `keys` are sorted, rows outside them do not exist."""
    shared = np.full(len(keys), -1)
    far = p.window + 1
    if len(keys) > far:
        bits = equal_bits(keys[:-far], keys[far:])
        shared[:-far] = bits
        shared[far:] = np.maximum(shared[far:], bits)
    met = np.where(shared < 64, (1 - acos(p.cosine) / pi) ** (shared + 1.0), 0.0)
    return np.floor(-np.log(np.maximum(1 - met, 1e-9)) * UNIT).astype(np.int64)


def _stars(found: list) -> pa.RecordBatch:
    """Links (arrays a, b) -> links to the smallest vector of each local component."""
    nodes, low = local_components(*(np.concatenate([f[k] for f in found]) for k in (0, 1)))
    keep = nodes != low
    return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(low[keep]), pa.nulls(int(keep.sum()), pa.int64())],
                                      names=["a", "b", "sure"])


def _window_pairs(kind: str, p: Params):
    """Blocks in order -> links of verified pairs, and for each vector (a) how sure its neighbours were met."""
    def run(batches):
        found = []
        for ids, raws, keys, own in _by_block(batches, ["vec_id", "raw", "key", "own"]):
            x, ids, own = unit(raws, kind), np.array(ids, np.int64), np.array(own)
            sure = sureness(np.array(keys, np.int64), p)
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.nulls(int(own.sum()), pa.int64()), pa.array(sure[own])],
                                                 names=["a", "b", "sure"])
            for step in range(1, min(p.window, len(ids) - 1) + 1):
                hit = np.flatnonzero((x[:-step] * x[step:]).sum(1) >= p.cosine)
                if len(hit):
                    found.append((ids[hit], ids[hit + step]))
            if sum(len(f[0]) for f in found) > 200_000:
                yield _stars(found)
                found = []
        if found:
            yield _stars(found)

    return run


def _block_pairs(kind: str, p: Params):
    """Blocks of parts that meet -> links of all their pairs at the threshold or above."""
    def run(batches):
        for ids, raws, sides in _by_block(batches, ["vec_id", "raw", "side"]):
            x, side, ids = unit(raws, kind), np.array(sides), np.array(ids, np.int64)
            a, b = (np.flatnonzero(side != 1), np.flatnonzero(side != 0))  # a part with itself is side 2
            i, j = np.nonzero(x[a] @ x[b].T >= p.cosine)
            if len(i):
                yield _stars([(ids[a[i]], ids[b[j]])])

    return run


def _meetings(rows: DataFrame, group: str, p: Params) -> DataFrame:
    """Blocks in which every row meets every row of its group: part i meets part
    j >= i in block (i, j); a part with itself is side 2."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(p.block // 2)).cast("int").alias("parts"))
    members = rows.join(sizes, group).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least("part", k).alias("i"), F.greatest("part", k).alias("j"))))
    members = members.withColumn("meet", meets)
    side = F.when(F.col("meet.i") == F.col("meet.j"), 2).otherwise((F.col("part") == F.col("meet.j")).cast("int"))
    return (members.select(F.xxhash64(group, "meet.i", "meet.j").alias("block"), "vec_id", "raw", side.alias("side"), "weight")
            .repartition("block").sortWithinPartitions("block"))


def _pass_links(reps: DataFrame, kind: str, p: Params) -> DataFrame:
    """(a, b): links that connect the pairs at the threshold or above, for the wanted recall."""
    names, need = ["vec_id", "dim", "raw", "weight"], ceil(-log(max(1 - p.recall, 1e-9)) * UNIT)
    rest, links = reps.withColumn("sure", F.lit(0).cast("long")), None
    first, count = 0, passes_for(reps.count(), p)
    while True:
        keyed = rest.mapInArrow(lean(_keys(kind, range(first, first + count), p.seed)),
                                "number int, dim int, key long, vec_id long, raw binary")
        order = rank_within(keyed, ["number", "dim"], ["key", "vec_id"])
        at, far = F.col("rank") - 1, p.window + 1
        # `far` rows at the ends of a block also stand in its neighbours.
        nth = F.floor(at / F.lit(p.block))
        near = F.array_compact(F.array(nth, F.when(at % p.block >= p.block - far, nth + 1),
                                       F.when((at % p.block < far) & (nth > 0), nth - 1)))
        blocks = (order.withColumn("home", nth).withColumn("nth", F.explode(near))
                  .select(F.xxhash64("number", "dim", "nth").alias("block"), "rank", "vec_id", "raw", "key",
                          (F.col("home") == F.col("nth")).alias("own"))
                  .repartition("block").sortWithinPartitions("block", "rank"))
        met = written(blocks.mapInArrow(lean(_window_pairs(kind, p)), "a long, b long, sure long"), "met")
        found = met.where("b IS NOT NULL").select("a", "b")
        links = found if links is None else links.unionByName(found)
        gained = met.where("b IS NULL").groupBy(F.col("a").alias("vec_id")).agg(F.sum("sure").alias("gained"))
        rest = written(rest.join(gained, "vec_id").withColumn("sure", F.col("sure") + F.col("gained"))
                       .where(F.col("sure") < need).select(*names, "sure"), "unsettled")
        left, first, count = rest.count(), first + count, 2 * count
        if not left:
            return links
        if left <= ROWS_PER_PASS * count:
            every = _meetings(rest, "dim", p).mapInArrow(lean(_block_pairs(kind, p)), "a long, b long, sure long")
            return links.unionByName(every.select("a", "b"))


def _count_links(kind: str, p: Params):
    """Blocks of one component -> (vec_id, links): weights of the other vectors at the threshold or above."""
    def run(batches):
        ids_out, links_out = [], []
        for ids, raws, sides, weights in _by_block(batches, ["vec_id", "raw", "side", "weight"]):
            x, side = unit(raws, kind), np.array(sides)
            ids, weight = np.array(ids, np.int64), np.array(weights, np.int64)
            if side[0] == 2:  # a part with itself
                near = x @ x.T >= p.cosine
                np.fill_diagonal(near, False)
                ids_out.append(ids)
                links_out.append(near @ weight)
            elif len(np.unique(side)) == 2:
                a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                near = x[a] @ x[b].T >= p.cosine
                ids_out += [ids[a], ids[b]]
                links_out += [near @ weight[b], near.T @ weight[a]]
            if sum(map(len, ids_out)) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids_out)), pa.array(np.concatenate(links_out))],
                                                 names=["vec_id", "links"])
                ids_out, links_out = [], []
        if ids_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids_out)), pa.array(np.concatenate(links_out))],
                                             names=["vec_id", "links"])

    return run


def embedding_duplicates(vectors: DataFrame, params: Params = Params(), id_col: str = "vec_id",
                         vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors`."""
    p = params
    double = isinstance(vectors.schema[vector_col].dataType.elementType, T.DoubleType)
    kind = "<f8" if double else "<f4"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>" if double else "array<float>").alias("embedding"))
    usable = rows.mapInArrow(lean(_usable(kind)), "vec_id long, dim int, raw binary")
    usable = written(usable.withColumn("code", F.md5("raw")), "vectors")
    same = written(usable.groupBy("code").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("weight")), "equal")
    reps = written(usable.join(same.select(F.col("rep").alias("vec_id"), "code", "weight"), ["vec_id", "code"])
                   .dropDuplicates(["vec_id", "code"]).select("vec_id", "dim", "raw", "weight"), "vectors")

    links = _pass_links(reps, kind, p)
    groups = written(components(links), "components")

    # All links inside each component.
    members = groups.withColumnRenamed("id", "vec_id").join(reps, "vec_id")
    blocks = _meetings(members, "component_id", p)
    counts = blocks.mapInArrow(lean(_count_links(kind, p)), "vec_id long, links long").groupBy("vec_id").agg(F.sum("links").alias("links"))

    # Representatives, then every vector equal to one.
    found = (same.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left")
             .join(groups.select(F.col("id").alias("rep"), "component_id"), "rep", "left")
             .select("code", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component_id", "rep").alias("component_id")))
    linked = (usable.select("vec_id", "code").join(found, "code").groupBy("vec_id")
              .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    return (rows.select("vec_id").join(linked, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"),
                    F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept")))
