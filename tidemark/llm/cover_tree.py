"""Exact pairs of vectors above a cosine, by dual traversal of cover trees, and their groups.

On the unit sphere a cosine of at least c is a distance of at most sqrt(2 - 2c). Vectors of a label are
laid out in blocks of bounded size: by the nearest of a few pivots (the top of the tree, chosen from a
bounded sample) and, in crowded cells, by a hash. Blocks whose covering balls are too far apart never
meet. For two blocks that do, a task builds their cover trees, nested centres with halving radii, and
walks both together: a pair of nodes is dropped as soon as their centres' distance exceeds the
threshold plus both covering radii; what is left at the bottom is compared exactly.

A task gives the number of links of each of its vectors and a spanning forest of the links, at most one
row per vector, so groups of near copies are never written out pair by pair.

Defined results: vectors that are null, zero or not finite and rows without a label link with nothing
and are groups of their own; rows that repeat an id count as vectors that link, under one id; null ids
are left out; vectors of different lengths in one label are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.llm.graph import connected_components
from tidemark.llm.vectors import matrix, vector_rows
from tidemark.sources.scratch import cut_lineage, stored

COSINE = 0.98
BLOCK = 2048
SAMPLE = 4096
PIVOTS = 16
LEVELS = 6
_SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class CoverTree:
    """Nested centres of unit vectors: radius 2 at the top, half of it at each level below.

    ``levels[j]``: centre of each node (an index of a vector), its parent's index in the level above, and
    its covering radius, the largest distance to a vector below it. ``leaf``: each vector's last node.
    """

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.x = x
        owner = np.zeros(len(x), np.int64)
        self.levels = [(np.zeros(1, np.int64), np.zeros(1, np.int64), self._radii(np.zeros(1, np.int64), owner))]
        radius = 2.0
        for _ in range(levels):
            radius /= 2
            above = self.levels[-1][0]
            centres, parents, below = [], [], np.full(len(x), -1, np.int64)
            for node in range(len(above)):
                left = np.flatnonzero(owner == node) if len(above) == 1 else members[node]
                centre = above[node]  # nested: a centre stays one
                while len(left):
                    near = distances(x[centre : centre + 1], x[left])[0] <= radius
                    near |= left == centre
                    below[left[near]] = len(centres)
                    centres.append(centre)
                    parents.append(node)
                    left = left[~near]
                    centre = left[0] if len(left) else -1
            owner = below
            order = np.argsort(owner, kind="stable")
            members = np.split(order, np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1])
            nodes = np.array(centres, np.int64)
            self.levels.append((nodes, np.array(parents, np.int64), self._radii(nodes, owner)))
        self.leaf = owner

    def _radii(self, centres: np.ndarray, owner: np.ndarray) -> np.ndarray:
        gap = self.x - self.x[centres[owner]]
        radii = np.zeros(len(centres))
        np.maximum.at(radii, owner, np.sqrt((gap * gap).sum(axis=1)))
        return radii


def dual_traversal(a: CoverTree, b: CoverTree, reach: float) -> np.ndarray:
    """Which vectors of ``a`` and ``b`` lie in node pairs that no covering radius excludes."""
    alive = np.ones((1, 1), bool)
    for (ca, pa_, ra), (cb, pb, rb) in zip(a.levels, b.levels):
        alive = alive[pa_][:, pb]
        if not alive.any():
            return np.zeros((len(a.x), len(b.x)), bool)
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        far = np.ones(alive.shape, bool)
        gap = distances(a.x[ca[rows]], b.x[cb[columns]])
        far[np.ix_(rows, columns)] = gap > reach + ra[rows][:, None] + rb[columns][None, :] + _SLACK
        alive &= ~far
    return alive[a.leaf][:, b.leaf]


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs of rows with at least that cosine, found by cover trees, decided in double precision."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)), bool)
    one = CoverTree(unit(x))
    two = one if y is x else CoverTree(unit(y))
    near = dual_traversal(one, two, np.sqrt(max(2.0 - 2.0 * cosine, 0.0)))
    i, j = np.nonzero(near)
    norm_x, norm_y = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    for start in range(0, len(i), 1 << 16):
        p, q = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
        exact = (x[p] * y[q]).sum(axis=1) / (norm_x[p] * norm_y[q])
        near[p, q] = exact >= cosine
    return near


def spanning_forest(links: np.ndarray, n: int, same: bool) -> list[tuple[int, int]]:
    """Edges that connect what the links connect; the second block's vectors count on from ``n``."""
    parent = list(range(n if same else n + links.shape[1]))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i, j in np.argwhere(links).tolist():
        p, q = root(i), root(j if same else n + j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            edges.append((i, j))
    return edges


# --- Spark jobs ------------------------------------------------------------------------------


def _pivots(sample: list) -> dict[object, np.ndarray]:
    """Up to ``PIVOTS`` sampled vectors of each label, each far from those before it."""
    by_label: dict[object, list] = {}
    for label, vector in sample:
        by_label.setdefault(label, []).append(vector)
    found = {}
    for label, vectors in by_label.items():
        x = unit(np.array(vectors, float))
        chosen, gap = [0], distances(x, x[:1])[:, 0]
        while len(chosen) < min(PIVOTS, len(x)) and gap.max() > 0.5:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(x, x[chosen[-1:]])[:, 0])
        found[label] = x[chosen]
    return found


def _cells(pivots: dict[object, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            cell = np.zeros(len(x), np.int64)
            for label in set(labels.tolist()):
                mine = np.flatnonzero(labels == label)
                if label in pivots:
                    cell[mine] = distances(unit(x[mine]), pivots[label]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return run


def _ball(key: tuple, block: pa.Table) -> pa.Table:
    x = unit(matrix(block.column("vector")))
    centre = x.mean(axis=0)
    radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
    columns = [pa.array([k.as_py()], k.type) for k in key]
    centre = pa.array([centre.tolist()], pa.list_(pa.float64()))
    return pa.table([*columns, centre, pa.array([radius])], names=["label", "block", "centre", "radius"])


def _block_links(cosine: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        side = np.asarray(rows.column("side"))
        ids, x = np.asarray(rows.column("id")), matrix(rows.column("vector"))
        same = key[1].as_py() == key[2].as_py()
        one, two = (side == 0), (side == (0 if same else 1))
        xa = x[one]
        links = linked(xa, xa if same else x[two], cosine)
        if same:
            np.fill_diagonal(links, False)
        ia, ib = ids[one], ids[two]
        counts = dict(zip(ia.tolist(), links.sum(axis=1).tolist()))
        found = [(i, None, n) for i, n in counts.items() if n] if len(counts) == len(ia) else [
            (i, None, n) for i, n in zip(ia.tolist(), links.sum(axis=1).tolist()) if n
        ]
        if not same:
            found += [(i, None, n) for i, n in zip(ib.tolist(), links.sum(axis=0).tolist()) if n]
        found += [(int(ia[i]), int(ib[j]), 0) for i, j in spanning_forest(links, len(ia), same)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), (), ()))], schema=schema)

    return run


def cosine_groups(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE
) -> DataFrame:
    """(id, n_links, component_id, kept): links with other vectors of the label, smallest id of the group."""
    usable = vector_rows(rows, id_col, vector_col, label=label_col).filter("label is not null")
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("label", "vector").collect()
    kind = dict(usable.dtypes)["label"]
    cells = stored(
        usable.mapInArrow(_cells(_pivots(sample)), f"id long, vector array<double>, label {kind}, cell long"), "cells"
    )
    crowd = cells.groupBy("label", "cell").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK))
    blocks = stored(
        cells.join(crowd, ["label", "cell"]).select(
            "id", "vector", "label", (F.shiftleft("cell", 40) + part).cast("long").alias("block")
        ),
        "blocks",
    )
    balls = cut_lineage(
        blocks.groupBy("label", "block").applyInArrow(
            _ball, f"label {kind}, block long, centre array<double>, radius double"
        )
    )
    a, b = balls.alias("a"), balls.alias("b")
    gap = F.aggregate(F.zip_with("a.centre", "b.centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    reach = float(np.sqrt(max(2.0 - 2.0 * cosine, 0.0))) + _SLACK
    meet = (F.col("a.label") == F.col("b.label")) & (F.col("a.block") <= F.col("b.block"))
    pairs = a.join(b, meet & (F.sqrt(gap) <= F.col("a.radius") + F.col("b.radius") + reach)).select(
        F.col("a.label").alias("label"), F.col("a.block").alias("one"), F.col("b.block").alias("two")
    )
    sides = pairs.select(
        "label", "one", "two", F.explode(F.when(F.col("one") == F.col("two"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side")
    ).withColumn("block", F.when(F.col("side") == 0, F.col("one")).otherwise(F.col("two")))
    tasks = sides.join(blocks, ["label", "block"]).select("label", "one", "two", "side", "id", "vector")
    found = stored(
        tasks.groupBy("label", "one", "two").applyInArrow(_block_links(cosine), "a long, b long, n long"), "links"
    )
    counts = found.filter("b is null").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("n_links"))
    groups = connected_components(found.filter("b is not null").select("a", "b"))
    every = as_table(rows, id=id_col).filter("id is not null")
    joined = every.join(counts, F.col("id") == F.col("linked"), "left").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
