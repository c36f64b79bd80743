"""Connected components of a table of links, on Spark.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each step is a partial aggregate
and an equi-join, so a vertex with very many links is split like any skewed
join key, and no component is ever gathered in one task.  Before the first
step the links are contracted to stars in tasks of about `TASK_LINKS` links, which
usually leaves two or three rounds, and none where one such task holds all
links that are left.  Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written


TASK_LINKS = 1_000_000  # links (16 bytes each) that a task contracts at a time


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of the links (a[i], b[i]) and the smallest vertex reachable from each."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        low = np.minimum(lx, ly)
        new = label.copy()
        np.minimum.at(new, lx, low)
        np.minimum.at(new, ly, low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _contract(batches):
    """Links of a task -> links to the smallest vertex of each local component."""
    held, rows = [], 0

    def flush():
        a = np.concatenate([h[0] for h in held])
        b = np.concatenate([h[1] for h in held])
        nodes, low = local_components(a, b)
        keep = nodes != low
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(low[keep])], names=["a", "b"])

    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        rows += batch.num_rows
        if rows >= TASK_LINKS:
            yield flush()
            held, rows = [], 0
    if rows:
        yield flush()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every vertex of `links`; component_id is the
    smallest vertex of its component.  Links with a NULL end are no links."""
    start = (links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
             .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))))
    now = written(start.mapInArrow(lean(_contract), "a long, b long"), "links")
    tasks = -(-now.count() // TASK_LINKS)
    if tasks <= 1:
        return _membership(now.coalesce(1).mapInArrow(lean(_contract), "a long, b long"))
    now = written(now.repartition(tasks, "a").mapInArrow(lean(_contract), "a long, b long").distinct(), "links")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
    before = None
    while (state := tuple(mark(now))) != before:
        before = state
        # Large star: every larger neighbour of a vertex links to the smallest one it knows.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "links")
        # Small star: its smaller neighbours, and the vertex itself, link to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                 F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))
        small = large.join(low, "a").select(ends.alias("e")).select("e.a", "e.b")
        now = written(small.where(F.col("a") != F.col("b")).distinct(), "links")
    return _membership(now)


def _membership(stars: DataFrame) -> DataFrame:
    """(id, component_id) of every end of the stars (vertex, smallest vertex of its component)."""
    roots = stars.select(F.col("b").alias("id")).distinct()
    return (stars.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
            .unionByName(roots.select("id", F.col("id").alias("component_id"))))
