"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

The forest is fitted on at most ``SAMPLE`` vectors (those with the smallest hash of their id): each node
splits its vectors at the median of their projection on the line through two of them. Every row of the
table is then put in its leaf of every tree. A query walks all trees at once through one priority queue
of nodes, ordered by the smallest margin on their way, until ``share`` of all leaves are visited; rows in
a visited leaf of any tree are candidates, and candidates are ranked by the exact inner product.

Rows lie in blocks of bounded size, near ones together; the queries, a stated set, come to the blocks in
blocks of bounded size themselves, and each meeting keeps ``k`` rows per query.

``SHARE`` is high because the vectors here have 64 independent directions, in which no tree separates
neighbours well; for vectors of low intrinsic dimension a small part of it gives the same recall.

Defined results: vectors that are null, zero or not finite and null ids take no part; rows that repeat
an id are candidates of their own; ties go to the smaller id; with fewer than ``k`` candidates a query
has fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import matrix, vector_rows
from tidemark.sources.scratch import stored

SAMPLE = 8192
TREES = 4
LEAF = 32
SHARE = 0.3
K = 20
BLOCK = 4096
QUERY_BLOCK = 2048


@dataclass(frozen=True)
class Tree:
    """``children[node]``: two nodes, or leaves as -1 - leaf; leaves are numbered from left to right."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.cuts) else np.full(len(x), -1, np.int64)
        while (at >= 0).any():
            inner = np.flatnonzero(at >= 0)
            node = at[inner]
            right = (x[inner] * self.normals[node]).sum(axis=1) > self.cuts[node]
            at[inner] = self.children[node, right.astype(np.int64)]
        return -1 - at


def grow_tree(x: np.ndarray, leaf: int, random: np.random.Generator) -> Tree:
    normals, cuts, children = [], [], []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            a, b = random.choice(rows, 2, replace=False)
            normal = x[a] - x[b]
            place = x[rows] @ normal
            cut = float(np.median(place))
            left, right = rows[place <= cut], rows[place > cut]
            if len(left) and len(right):
                node = len(cuts)
                normals.append(normal)
                cuts.append(cut)
                children.append([0, 0])
                children[node] = [grow(left), grow(right)]
                return node
        leaves += 1
        return -leaves

    grow(np.arange(len(x)))
    return Tree(np.array(normals, float).reshape(len(cuts), x.shape[1]), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), leaves)


def visited_leaves(trees: list[Tree], query: np.ndarray, share: float) -> list[np.ndarray]:
    """For each tree which leaves the query visits: best first over all trees, by one priority queue."""
    seen = [np.zeros(t.leaves, bool) for t in trees]
    wanted = int(np.ceil(share * sum(t.leaves for t in trees)))
    margins = [t.normals @ query - t.cuts if len(t.cuts) else t.cuts for t in trees]
    queue = [(-np.inf, i, 0 if len(t.cuts) else -1) for i, t in enumerate(trees)]
    while queue and wanted:
        worst, i, node = heapq.heappop(queue)
        while node >= 0:  # down the near side; the far side waits with its margin
            margin = float(margins[i][node])
            near, far = trees[i].children[node][:: 1 if margin <= 0 else -1]
            heapq.heappush(queue, (max(worst, abs(margin)), i, int(far)))
            node = int(near)
        seen[i][-1 - node] = True
        wanted -= 1
    return seen


def fitted_forest(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF) -> list[Tree]:
    return [grow_tree(sample, leaf, np.random.default_rng(seed)) for seed in range(trees)]


def _indexed(trees: list[Tree], share: float, queries: bool):
    """Each row's leaves; for queries, the leaves they visit, all trees' one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            if queries:
                marks = [np.packbits(np.concatenate(visited_leaves(trees, q, share))).tobytes() for q in x]
                cell = np.zeros(len(x), np.int64)
            else:
                leaves = np.array([t.leaf_of(x) for t in trees], np.int32).T
                marks = [row.tobytes() for row in leaves]
                cell = leaves[:, 0].astype(np.int64) * 16 // max(trees[0].leaves, 1) if len(leaves) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(marks, pa.binary()), pa.array(cell)],
                ["id", "vector", "marks", "cell"],
            )

    return run


def nearest_candidates(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, allowed: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """(query, row, score) of each query's best ``k`` allowed rows, scores summed the same way everywhere."""
    rough = np.where(allowed, queries @ rows.T, -np.inf)
    found = []
    for q, scores in enumerate(rough):
        possible = int(allowed[q].sum())
        if not possible:
            continue
        least = np.partition(scores, len(scores) - min(k, possible))[len(scores) - min(k, possible)]
        near = np.flatnonzero((scores >= least - 1e-9 * max(1.0, abs(least))) & allowed[q])
        exact = (rows[near] * queries[q]).sum(axis=1)
        best = np.lexsort((row_ids[near], -exact))[:k]
        found += [(int(query_ids[q]), int(row_ids[near[i]]), float(exact[i])) for i in best]
    return found


def _met(leaves: list[int], k: int):
    bounds = np.cumsum([0, *leaves])
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if rows.num_rows and asked.num_rows:
            ids, query_ids = np.asarray(rows.column("id")), np.asarray(asked.column("id"))
            at = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.int32).reshape(len(ids), -1)
            bits = np.frombuffer(b"".join(asked.column("marks").to_pylist()), np.uint8).reshape(len(query_ids), -1)
            seen = np.unpackbits(bits, axis=1)[:, : bounds[-1]].astype(bool)
            allowed = np.zeros((len(query_ids), len(ids)), bool)
            for t in range(at.shape[1]):
                allowed |= seen[:, bounds[t] + at[:, t]]
            allowed &= query_ids[:, None] != ids[None, :]
            found = nearest_candidates(matrix(asked.column("vector")), query_ids, matrix(rows.column("vector")), ids, allowed, k)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found) if found else ((), (), ()), schema)], schema=schema)

    return run


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, share: float = SHARE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query, its own id left out."""
    usable = vector_rows(rows, id_col, vector_col)
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    trees = fitted_forest(np.array([r[0] for r in sample], float) if sample else np.zeros((0, 1)))
    kind = "id long, vector array<double>, marks binary, cell long"
    index = stored(usable.mapInArrow(_indexed(trees, share, False), kind), "leaves")
    asked = vector_rows(queries, id_col, vector_col).repartition("id").mapInArrow(_indexed(trees, share, True), kind)
    asked = stored(asked, "asked")
    crowd = index.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    n_asked = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = index.join(crowd, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    blocks = blocks.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    places = crowd.select(F.col("cell").alias("place"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    turns = places.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    asked = asked.drop("cell").withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(n_asked)).cast("int"))
    sent = asked.join(turns, "turn").withColumnRenamed("place", "cell")
    met = (
        blocks.select("cell", "part", "turn", "id", "vector", "marks")
        .groupBy("cell", "part", "turn")
        .cogroup(sent.select("cell", "part", "turn", "id", "vector", "marks").groupBy("cell", "part", "turn"))
        .applyInArrow(_met([t.leaves for t in trees], k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
