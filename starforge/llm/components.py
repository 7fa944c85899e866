"""Connected components of a large graph by DataFrame joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

# Links that one task joins up at a time.
CHUNK = 200_000


def _stars(links: DataFrame, chunks: int) -> DataFrame:
    """Replace the links of each chunk by ``a, b`` from every node to the least
    node of its component within the chunk."""

    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def done():
            nodes = np.fromiter(parent, np.int64, len(parent))
            roots = np.fromiter(map(root, parent), np.int64, len(parent))
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

        seen = 0
        for batch in batches:
            for a, b in zip(*[c.to_pylist() for c in batch.columns]):
                a, b = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
                parent[max(a, b)] = min(a, b)
            seen += batch.num_rows
            if seen >= 2 * CHUNK:
                yield done()
                seen = 0
        if parent:
            yield done()

    return links.select("a", "b").repartition(chunks).mapInArrow(run, "a long, b long")


def connected_components(links: DataFrame) -> DataFrame:
    """``a, b`` (longs) to ``node, component``, the smallest node reachable.

    Links are joined up in chunks of bounded size, each by one task, which
    leaves stars. If there was one chunk that is the answer. Otherwise rounds of
    joins follow: each node takes the least label among its neighbours, then the
    label of its label, so paths shorten by half or better. Labels are written
    after each round; the driver sees one count per round. A hub's links are
    one row per task after the partial aggregate; the joins on a hub are
    sort-merge joins whose hot partitions are split at run time.
    """
    chunks = links.count() // CHUNK + 1
    stars = materialise(_stars(links, chunks), "component-stars")
    if chunks == 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    both = materialise(stars.union(stars.select("b", "a")).distinct(), "component-links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = materialise(labels.select("node", F.least("node", "low").alias("label")), "component-labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("low")
        )
        lower = materialise(lower, "component-lower")
        jump = lower.select(F.col("node").alias("at"), F.col("low").alias("end"))
        moved = lower.join(jump, lower["low"] == jump["at"]).select(
            "node", F.col("end").alias("label"), (F.col("end") != F.col("label")).alias("changed")
        )
        moved = materialise(moved, "component-labels")
        labels = moved.select("node", "label")
        if not moved.filter("changed").limit(1).count():
            return labels.withColumnRenamed("label", "component")
