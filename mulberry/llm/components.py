"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

Neither edges nor components reach the driver: each round is a few joins and aggregates, written to the shared folder, and ends
with two sums; no side of a join is broadcast. Before the rounds, each task reduces its own edges to a forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fewer, forget, shuffled, written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges -> (node, least node of its component among these edges), nodes that are not the least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_a, held_b, n = [], [], 0
    for batch in batches:
        held_a.append(batch.column(0).to_numpy())
        held_b.append(batch.column(1).to_numpy())
        n += batch.num_rows
        if n > 500_000:
            a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
            if 2 * len(a) > n:  # little to gain: pass it on
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])
                a, b = a[:0], b[:0]
            held_a, held_b, n = [a], [b], len(a)
    if n:
        a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: what each task holds becomes a forest. Columns u > v."""
    return edges.mapInArrow(_thinned, "u long, v long")


def _stars(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step over edges u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(shuffled(least), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(shuffled(lowest), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionAll(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> node, root: every node of an edge but the roots, and the least node that it is connected with."""
    oriented = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, state = written(thinned(oriented), "edges"), None
    while True:
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
        if not row[0]:
            break
        before, now = now, written(fewer(_stars(now)), "edges")
        forget(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
