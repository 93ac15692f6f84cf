"""Connected components of a table of links, and sorted streams read group by group."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage

#: Rows that are turned into Python objects at a time.
_PORTION = 500


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of (a, b) links; a component is named by its smallest node.

    Every round a node takes the smallest label among its neighbours, then its label's label; each round
    is stored, so the plan stays short and no round is repeated.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.filter("a <> b").distinct())
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
    )
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("root_label"))
        jumped = lowered.join(roots, F.col("label") == F.col("root"))
        jumped = cut_lineage(jumped.select("node", "old", F.least("label", "root_label").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")


def sorted_groups(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Groups of consecutive rows with one key; a group is held at a time, so its size must be bounded."""
    current, rows = None, []
    for batch in batches:
        for row in chain.from_iterable(batch.slice(i, _PORTION).to_pylist() for i in range(0, batch.num_rows, _PORTION)):
            own = tuple(row[k] for k in key)
            if own != current:
                if rows:
                    yield current, rows
                current, rows = own, []
            rows.append(row)
    if rows:
        yield current, rows
