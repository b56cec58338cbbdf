"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import written

NEAREST = 10
TREES = 16
#: Vectors that the trees are fitted on, at most, and rows that a leaf should hold.
SAMPLE = 20_000
LEAF_ROWS = 256
#: Queries that are compared with all rows to choose how many leaves to visit, and the recall wanted of them.
TRIALS, RECALL = 200, 0.96
#: Rows of a leaf, and queries to it, that one task compares at a time.
CHUNK = 20_000


def usable(vector: str) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


class Forest:
    """Split planes of all trees in common arrays; a child below zero is a leaf, numbered from -1 down."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 7):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        random = np.random.default_rng(seed)
        self.roots = [self._grow(sample, leaf, random) for _ in range(trees)]
        dim = sample.shape[1] if sample.ndim == 2 else 0
        self.normals = np.array(self.normals).reshape(-1, dim)
        self.offsets, self.children = np.array(self.offsets), np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, rows: np.ndarray, leaf: int, random: np.random.Generator) -> int:
        for _ in range(5 if len(rows) > leaf else 0):
            p, q = rows[random.choice(len(rows), 2, replace=False)]
            normal = p - q
            if not (length := np.sqrt(normal @ normal)):
                continue
            normal = normal / length
            along = rows @ normal
            offset = float((p + q) @ normal / 2)
            far = along > offset
            if min(far.sum(), (~far).sum()) < len(rows) // 10:
                offset = float(np.median(along))
                far = along > offset
            if not far.any() or far.all():
                continue
            self.normals.append(normal)
            self.offsets.append(offset)
            self.children.append([0, 0])
            node = len(self.children) - 1
            self.children[node] = [self._grow(rows[~far], leaf, random), self._grow(rows[far], leaf, random)]
            return node
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, from 0."""
        out = np.empty((len(rows), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            node = np.full(len(rows), root, np.int64)
            while (open_ := np.flatnonzero(node >= 0)).size:
                at = node[open_]
                side = np.einsum("ij,ij->i", rows[open_], self.normals[at]) > self.offsets[at]
                node[open_] = self.children[at, side.astype(np.int64)]
            out[:, t] = -node - 1
        return out

    def search(self, rows: np.ndarray, counts: np.ndarray, visited: int, enough: int) -> list[list[int]]:
        """Leaves for each query: one queue over all trees, the branch with the nearest plane first.

        Stops at `visited` leaves that together hold `enough` rows, or when there are no more.
        """
        out = []
        margins = rows @ self.normals.T - self.offsets if len(self.offsets) else np.zeros((len(rows), 0))
        for margin in margins.tolist():
            queue = [(-np.inf, root) for root in self.roots]
            found, held = [], 0
            while queue and (len(found) < visited or held < enough):
                cost, node = heapq.heappop(queue)
                while node >= 0:
                    m = margin[node]
                    near, far = self.children[node, int(m > 0)], self.children[node, int(m <= 0)]
                    heapq.heappush(queue, (max(cost, abs(m)), int(far)))
                    node = int(near)
                found.append(-node - 1)
                held += int(counts[-node - 1])
            out.append(found)
        return out


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _closest(queries: np.ndarray, names: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """The k nearest rows of each query, by exact distance; ties to the smaller id."""
    squares = (rows * rows).sum(1)
    for q, name in zip(queries, names.tolist()):
        rough = squares - 2 * (rows @ q)
        other = np.flatnonzero(ids != name)
        if len(other) > k:
            rough = rough[other]
            reach = np.partition(rough, k - 1)[k - 1]
            other = other[rough <= reach + 1e-7 * (abs(reach) + float(q @ q) + 1)]
        exact = np.sqrt(((rows[other] - q) ** 2).sum(1))
        for i in np.lexsort((ids[other], exact))[:k].tolist():
            yield int(name), int(ids[other[i]]), float(exact[i])


def _visits_for(index: DataFrame, forest: Forest, dim: int, k: int, trials: int, recall: float) -> int:
    """How many leaves queries must visit so that `recall` of the true neighbours of trial queries are found.

    Each task compares its rows with the trial queries and keeps k for each, so all rows are read
    and at most `trials` * k rows a task go on.
    """
    chosen = index.filter("is_query").select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(trials).collect()
    queries, names = np.array([r.vector for r in chosen], np.float64).reshape(-1, dim), [r.vec_id for r in chosen]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, list[int]]]] = [[] for _ in names]
        for batch in batches:
            rows, ids = _matrix(batch["vector"], dim), batch["vec_id"].to_numpy()
            leaves = batch["leaves"].flatten().to_numpy().reshape(len(rows), -1)
            near = (rows * rows).sum(1) - 2 * queries @ rows.T
            for q, name in enumerate(names):
                far = np.where(ids == name, np.inf, near[q])
                few = np.argpartition(far, k)[:k] if len(far) > k else np.arange(len(far))
                found = [(float(far[i]), int(ids[i]), leaves[i].tolist()) for i in few.tolist() if far[i] < np.inf]
                best[q] = sorted(best[q] + found)[:k]
        rows = [(q, d, i, x) for q, found in enumerate(best) for d, i, x in found]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = (pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query", "near", "vec_id", "leaves"])

    found = index.select("vec_id", "vector", "leaves").mapInArrow(scan, "query int, near double, vec_id long, leaves array<int>")
    order = Window.partitionBy("query").orderBy("near", "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "leaves").collect()
    whole = forest.search(queries, np.zeros(max(forest.leaves, 1), np.int64), forest.leaves, 0)
    ranks = [{leaf: i + 1 for i, leaf in enumerate(order)} for order in whole]
    needed = sorted(min(ranks[r.query][leaf] for leaf in r.leaves) for r in found)
    return needed[min(len(needed) - 1, int(recall * len(needed)))] if needed else 1


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, id: str = "vec_id", vector: str = "embedding",
    trees: int = TREES, recall: float = RECALL, trials: int = TRIALS, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query by Euclidean distance.

    Trees are fitted on up to `sample` vectors, chosen by a digest of their id; every row is indexed
    in every tree. Up to `trials` queries are first compared with all rows, to choose the number of
    leaves that gives them `recall`. A query takes the rows of the leaves nearest to it and ranks them
    by exact distance in double precision, ties to the smaller id. A leaf of many rows or queries is
    compared in chunks by several tasks. With few rows all are compared.

    Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
    take no part, nor do rows without id. Rows that share an id are one candidate at its least
    distance, and no row is a candidate for a query of its id. Equal vectors under other ids are
    candidates like any. No rows or queries give no rows; other columns are not read.
    """
    rows = vectors.filter(F.col(id).isNotNull() & usable(vector)).select(
        F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    kind = rows.schema["vector"].dataType.simpleString()
    total = rows.count()
    chosen = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    dim = Counter(len(r.vector) for r in chosen).most_common(1)[0][0] if chosen else 1
    fitted = np.array([r.vector for r in chosen if len(r.vector) == dim], np.float64).reshape(-1, dim)
    forest = Forest(fitted, trees, max(8, leaf_rows * len(fitted) // max(total, 1)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.leaves_of(_matrix(batch["vector"], dim))
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * trees)
            leaves = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("vec_id", "vector", "is_query")), leaves], ["vec_id", "vector", "is_query", "leaves"])

    shape = f"vec_id long, vector {kind}, is_query boolean"
    placed = rows.filter(F.size("vector") == dim).mapInArrow(place, f"{shape}, leaves array<int>")
    index = written(placed, "forest")
    counts = np.zeros(max(forest.leaves, 1), np.int64)  # as many as the sample gave leaves
    for r in index.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).collect():
        counts[r.leaf] = r.n
    visited = _visits_for(index, forest, dim, k, trials, recall)
    enough = trees * (k + 1)  # rows that share an id aside, k others for certain

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.search(_matrix(batch["vector"], dim), counts, visited, enough)
            of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            leaf = pa.array([x for f in found for x in f], pa.int32())
            yield pa.RecordBatch.from_arrays([batch["vec_id"].take(of), batch["vector"].take(of), leaf], ["vec_id", "vector", "leaf"])

    asked = index.filter("is_query").select("vec_id", "vector").mapInArrow(visit, f"vec_id long, vector {kind}, leaf int")
    asked = written(asked, "visits")
    visits = {r.leaf: r.n for r in asked.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    large = [(leaf, int(-(-counts[leaf] // CHUNK)), -(-n // CHUNK)) for leaf, n in visits.items()]
    parts = vectors.sparkSession.createDataFrame(large or [(-1, 1, 1)], "leaf int, row_parts int, query_parts int")

    def part(of: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(of)).cast("int")

    def each(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    held = index.select("vec_id", "vector", F.explode("leaves").alias("leaf")).join(F.broadcast(parts), "leaf")
    held = held.select("leaf", part("row_parts").alias("i"), each("query_parts").alias("j"), "vec_id", "vector")
    asked = asked.join(F.broadcast(parts), "leaf")
    asked = asked.select("leaf", each("row_parts").alias("i"), part("query_parts").alias("j"), "vec_id", "vector")

    def compare(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and queries.num_rows:
            found = list(
                _closest(_matrix(queries["vector"], dim), queries["vec_id"].to_numpy(), _matrix(rows["vector"], dim), rows["vec_id"].to_numpy(), k)
            )
        columns = list(zip(*found)) if found else [[]] * 3
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    pairs = held.groupBy("leaf", "i", "j").cogroup(asked.groupBy("leaf", "i", "j")).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
