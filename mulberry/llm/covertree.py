"""Embedding near-duplicates by dual traversal of cover trees.

Distances are angles between vectors, which obey the triangle inequality. A tree's levels have radii that halve from level to
level; a node's centre is one of its points and is the centre of its first child as well, so levels are nested; each node knows the
largest angle from its centre to its points. Two nodes are held against each other by their centres' angle: beyond the threshold
by more than both radii, no pair below them links; within it by both radii, all pairs do, and are counted without being made; else
their children are compared, all of them by one matrix product, and at the leaves the cosines themselves in double precision.

Vectors are dealt into blocks of bounded size around centres drawn from a bounded sample; centres and radii prune pairs of blocks
as they do pairs of nodes. Every pair of blocks left is a task, which builds both trees and gives numbers of links for each vector
and a spanning forest of the links, never the pairs. Equal vectors are one point with a number.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different
lengths do not link; repeated rows are different vectors that link; null ids are never the smallest unless all are null; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .components import components, forest

COSINE = 0.9
#: Vectors in a block, about; blocks of one centre are divided by number where it has more.
BLOCK = 8192
#: Vectors that centres of blocks are drawn from, and centres at most.
SAMPLE, CENTRES = 4096, 256
RADII = (math.pi / 2, math.pi / 4, math.pi / 8, math.pi / 16)
#: Points and nodes held against others by one matrix product.
RUN = 256
#: Products in single precision, which only find candidates, are held against bounds this much lower.
ROUND = 1e-4
#: Bounds of angles are taken this much wider, so that rounding decides nothing: cosines decide near the threshold.
SLACK = 1e-6
FOUND = "a long, b long, links long"


def units(rows: list) -> list[bytes | None]:
    """Unit vectors in double precision as bytes; None where there is none."""
    out: list[bytes | None] = []
    for row in rows:
        v = None
        if row is not None and len(row) and None not in row:
            x = np.array(row, np.float64)
            most = np.abs(x).max()
            if np.isfinite(most) and most > 0:
                x = x / most
                v = (x / math.sqrt(float(x @ x)) + 0.0).tobytes()
        out.append(v)
    return out


class Node:
    __slots__ = ("children", "high", "low", "radius")

    def __init__(self, low: int, high: int, radius: float, children: list[Node]):
        self.low, self.high, self.radius, self.children = low, high, radius, children


def angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Tree:
    """Points in the order of the tree: a node's points stand together, its centre first."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order: list[int] = []
        self.root = self._node(np.arange(len(points)), 0, angle(points @ points[0]))
        self.points, self.order = points[self.order], np.array(self.order)

    def _node(self, own: np.ndarray, level: int, far: np.ndarray) -> Node:
        """own: points, the centre first; far: their angles from the centre."""
        low, radius = len(self.order), float(far.max()) if len(own) > 1 else 0.0
        if len(own) == 1 or level == len(RADII):
            self.order += own.tolist()
            return Node(low, low + len(own), radius, [])
        children, left, least = [], own, math.cos(RADII[level])
        while len(left):
            # candidates for centres come in runs, whose cosines to all points left are one product
            cosines, free = self.points[left[:RUN]] @ self.points[left].T, np.ones(len(left), bool)
            for i in range(len(cosines)):
                if free[i]:
                    near = (cosines[i] >= least) & free
                    near[i] = True
                    free &= ~near
                    at = np.flatnonzero(near)
                    at = np.concatenate([[i], at[at != i]])
                    children.append(self._node(left[at], level + 1, angle(cosines[i, at])))
            left = left[free]
        return Node(low, low + len(own), radius, children)


class Links:
    """Numbers of links and a forest of them, from traversals of two trees or of one with itself."""

    def __init__(self, a: Tree, na: np.ndarray, b: Tree | None = None, nb: np.ndarray | None = None, cosine: float = COSINE):
        self.cosine, self.limit, self.same = cosine, math.acos(cosine), b is None
        self.a, self.b = a, b or a
        self.na = na[a.order]
        self.nb = self.na if self.same else nb[b.order]
        self.links_a = np.zeros(len(na), np.int64)
        self.links_b = self.links_a if self.same else np.zeros(len(nb), np.int64)
        self.shift = 0 if self.same else len(na)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        if self.same:
            self._self(a.root)
        else:
            self._children([a.root], [b.root])

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        self.edges.append((x, y))
        self.held += len(x)
        if self.held > 400_000:
            self.edges = [forest(*(np.concatenate(e) for e in zip(*self.edges, strict=True)))]
            self.held = len(self.edges[0][0])

    def _self(self, node: Node) -> None:
        if node.high - node.low == 1:
            return
        if 2 * node.radius <= self.limit - SLACK:  # every pair of its points links
            own = slice(node.low, node.high)
            self.links_a[own] += self.na[own].sum() - self.na[own]
            rest = np.arange(node.low + 1, node.high)
            self._join(np.full(len(rest), node.low), rest)
            return
        if not node.children:
            self._exact(node, node)
            return
        for child in node.children:
            self._self(child)
        self._children(node.children, node.children, upper=True)

    def _children(self, some: list[Node], others: list[Node], upper: bool = False) -> None:
        # by radius, so that runs of nodes have tight bounds in common
        some = sorted(some, key=lambda x: x.radius)
        others = some if upper else sorted(others, key=lambda x: x.radius)
        low_a, low_b = np.array([x.low for x in some]), np.array([x.low for x in others])
        ra, rb = np.array([x.radius for x in some]), np.array([x.radius for x in others])
        single_a, single_b = np.array([x.high - x.low == 1 for x in some]), np.array([x.high - x.low == 1 for x in others])
        narrow_a, narrow_b = self.a.points[low_a].astype(np.float32), self.b.points[low_b].astype(np.float32)
        for i in range(0, len(some), RUN):
            for j in range(i if upper else 0, len(others), 4 * RUN):
                wide = self.limit + SLACK + float(ra[i : i + RUN].max() + rb[j : j + 4 * RUN].max())
                rows, columns = np.nonzero(narrow_a[i : i + RUN] @ narrow_b[j : j + 4 * RUN].T >= (math.cos(wide) if wide < math.pi else -1) - ROUND)
                rows, columns = rows + i, columns + j
                if upper:
                    rows, columns = rows[columns > rows], columns[columns > rows]
                if len(rows):
                    self._candidates(some, others, rows, columns, low_a, low_b, ra, rb, single_a[rows] & single_b[columns])

    def _candidates(self, some: list[Node], others: list[Node], rows: np.ndarray, columns: np.ndarray, low_a: np.ndarray, low_b: np.ndarray, ra: np.ndarray, rb: np.ndarray, single: np.ndarray) -> None:
        """Pairs of nodes, by their numbers: single points by their cosines, others by the bounds of their radii."""
        step = 1 << 14
        cosines = np.concatenate([np.einsum("ij,ij->i", self.a.points[low_a[rows[k : k + step]]], self.b.points[low_b[columns[k : k + step]]]) for k in range(0, len(rows), step)])
        linked = single & (cosines >= self.cosine)
        if linked.any():
            x, y = low_a[rows[linked]], low_b[columns[linked]]
            self.links_a += np.bincount(x, weights=self.nb[y], minlength=len(self.links_a)).astype(np.int64)
            self.links_b += np.bincount(y, weights=self.na[x], minlength=len(self.links_b)).astype(np.int64)
            self._join(x, y + self.shift)
        apart, reach = angle(cosines), ra[rows] + rb[columns]
        near = ~single & (apart - reach <= self.limit + SLACK)
        inside = apart + reach <= self.limit - SLACK
        for i, j, whole in zip(rows[near].tolist(), columns[near].tolist(), inside[near].tolist(), strict=True):
            x, y = some[i], others[j]
            if whole:
                self._all(x, y)
            elif not x.children and not y.children:
                self._exact(x, y)
            else:
                self._children(x.children or [x], y.children or [y])

    def _all(self, x: Node, y: Node) -> None:
        self.links_a[x.low : x.high] += self.nb[y.low : y.high].sum()
        self.links_b[y.low : y.high] += self.na[x.low : x.high].sum()
        self._join(np.array([x.low]), np.array([y.low + self.shift]))
        for node, shift, other in ((x, 0, y.low + self.shift), (y, self.shift, x.low)):
            if 2 * node.radius > self.limit - SLACK:  # else its own points are joined where it meets itself
                own = np.arange(node.low, node.high) + shift
                self._join(own, np.full(len(own), other))

    def _exact(self, x: Node, y: Node, most: int = 1024) -> None:
        for i in range(x.low, x.high, most):
            p = slice(i, min(i + most, x.high))
            for j in range(y.low if x is not y else i, y.high, most):
                q = slice(j, min(j + most, y.high))
                linked = self.a.points[p] @ self.b.points[q].T >= self.cosine
                if x is y and i == j:
                    linked = np.triu(linked, 1)
                rows, columns = np.nonzero(linked)
                if len(rows):
                    self.links_a[p] += np.bincount(rows, weights=self.nb[q][columns], minlength=p.stop - p.start).astype(np.int64)
                    self.links_b[q] += np.bincount(columns, weights=self.na[p][rows], minlength=q.stop - q.start).astype(np.int64)
                    self._join(rows + i, columns + j + self.shift)

    def result(self, ids_a: np.ndarray, ids_b: np.ndarray | None = None) -> pd.DataFrame:
        ids = ids_a[self.a.order] if self.same else np.concatenate([ids_a[self.a.order], ids_b[self.b.order]])
        links = self.links_a if self.same else np.concatenate([self.links_a, self.links_b])
        some = np.flatnonzero(links)
        x, y = forest(*(np.concatenate(e) for e in zip(*self.edges, strict=True))) if self.edges else (np.zeros(0, int), np.zeros(0, int))
        return pd.DataFrame({
            "a": np.concatenate([ids[some], ids[x]]).astype(np.int64), "b": pd.array([*[None] * len(some), *ids[y].tolist()], "Int64"),
            "links": np.concatenate([links[some], np.zeros(len(x), np.int64)]).astype(np.int64)})


def centres(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the sample's vectors, each the farthest from those before it."""
    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    return sample[chosen]


def points(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units(batch.column(1).to_pylist()), pa.binary())], ["vec_id", "v"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("e")).mapInArrow(run, "vec_id long, v binary")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    every = written(points(vectors, id_col, vector_col), "vectors")
    distinct = every.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    distinct = written(distinct.withColumn("cid", F.monotonically_increasing_id()), "points")
    found = written(_links(distinct, cosine), "links")
    counted = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    rooted = distinct.select("cid", "v", "least", "n").join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = rooted.join(smallest, "root").join(counted.withColumnRenamed("a", "cid"), "cid", "left").select("v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    alone = F.col("v").isNull()
    return every.join(labelled, "v", "left").select(
        "vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(distinct: DataFrame, cosine: float) -> DataFrame:
    spark = distinct.sparkSession
    size = F.octet_length("v")
    drawn = distinct.select(size.alias("size"), "v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    n = distinct.count()
    by_size: dict[int, np.ndarray] = {}
    for each in {x["size"] for x in drawn}:
        sample = np.frombuffer(b"".join(bytes(x["v"]) for x in drawn if x["size"] == each), np.float64).reshape(-1, each // 8)
        by_size[each] = centres(sample, max(1, min(CENTRES, -(-n // BLOCK))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = [], []
            for v in batch.column(1).to_pylist():
                if len(v) in by_size:
                    cosines = by_size[len(v)] @ np.frombuffer(v, np.float64)
                    best = int(cosines.argmax())
                    far.append(float(angle(cosines[best])))
                else:  # a length that the sample lacks
                    best = 0
                    far.append(math.pi)
                cell.append(best)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(v) for v in batch.column(1).to_pylist()], pa.int32()), pa.array(cell, pa.int32()), pa.array(far)], ["cid", "v", "n", "size", "cell", "far"])

    placed = written(distinct.select("cid", "v", "n").mapInArrow(place, "cid long, v binary, n long, size int, cell int, far double"), "placed")
    cells = placed.groupBy("size", "cell").agg(F.count("*").alias("k"), F.max("far").alias("radius")).orderBy("size", "cell").collect()  # at most CENTRES for each length
    limit, partners, blocks = math.acos(cosine) + SLACK, [], 0
    numbered = []
    for x in cells:
        numbered.append((x["size"], x["cell"], -(-x["k"] // BLOCK), x["radius"], blocks))
        blocks += -(-x["k"] // BLOCK)
    for size_i, cell_i, _, radius_i, _ in numbered:
        for size_j, cell_j, parts_j, radius_j, first_j in numbered:
            if size_i != size_j:
                continue
            middle = float(angle(by_size[size_i][cell_i] @ by_size[size_i][cell_j])) if size_i in by_size else 0.0
            if middle - radius_i - radius_j <= limit:
                partners.append((size_i, cell_i, first_j, parts_j))
    if not partners:
        return spark.createDataFrame([], FOUND)
    number = spark.createDataFrame([(s, c, k, first) for s, c, k, _, first in numbered], "size int, cell int, parts int, first long")
    dealt = placed.join(F.broadcast(number), ["size", "cell"]).withColumn("own", F.col("first") + F.pmod(F.xxhash64("cid"), F.col("parts")))
    # pairs of cells come from the driver, their pairs of blocks are made here
    dealt = dealt.join(F.broadcast(spark.createDataFrame(partners, "size int, cell int, first_other long, parts_other int")), ["size", "cell"])
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.col("first_other"), F.col("first_other") + F.col("parts_other") - 1)))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for side in (0, 1):
            own = rows[rows["side"] == side].sort_values("cid")
            if len(own):
                sides.append((np.frombuffer(b"".join(own["v"]), np.float64).reshape(len(own), -1), own["n"].to_numpy(np.int64), own["cid"].to_numpy(np.int64)))
        if len(sides) == 1:
            if rows["side"].iloc[0] or not rows["self"].iloc[0]:
                return pd.DataFrame({"a": [], "b": [], "links": []}).astype({"a": "int64", "b": "Int64", "links": "int64"})
            vectors, ns, ids = sides[0]
            return Links(Tree(vectors), ns, cosine=cosine).result(ids)
        (va, na, ia), (vb, nb, ib) = sides
        return Links(Tree(va), na, Tree(vb), nb, cosine).result(ia, ib)

    pair, side = F.least("own", "other") * F.lit(blocks).cast("long") + F.greatest("own", "other"), (F.col("own") > F.col("other")).cast("int")
    return dealt.select(pair.alias("pair"), side.alias("side"), "cid", "v", "n", (F.col("own") == F.col("other")).alias("self")).groupBy("pair").applyInPandas(link, FOUND)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
