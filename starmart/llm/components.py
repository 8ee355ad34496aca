"""Union-find grouping of links, spread over the cluster.

Union-find runs inside every partition of the links first, which leaves a forest of at most
one link per document and partition. Then, round by round, each document's label falls to the
least label among its neighbours, to its label's own label, and to the least label that any
document of the same label has next to it: that hooks whole trees at their root, not single
documents, so trees double as they meet, whatever the order of the ids along a chain. Labels
only fall, so it ends; a round that moves no label has found the least id of every group.

A third of all documents in one group is harmless: its links collapse to one per document, and
a label update is a minimum with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import map_in_arrow, written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find of the partition's links; one link to the least id per document."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    child = np.fromiter((x for x in parent if parent[x] != x), dtype=np.int64)
    root = np.fromiter((find(int(x)) for x in child), dtype=np.int64, count=len(child))
    yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``component``: least id reachable) of the ids in ``links`` (``a``, ``b`` long)."""
    pairs = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = written(map_in_arrow(pairs, _forest, "a long, b long"), "links")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("id"), F.least("a", "m").alias("component")),
                     "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        seen = written(labels.join(near, "id"), "labels-near")
        # what a label's documents see, for the label itself
        hook = seen.groupBy(F.col("component").alias("id")).agg(F.min("near").alias("hook"))
        hop = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        step = written(seen.join(hook, "id", "left").join(hop, "component", "left")
                       .select("id", F.least("component", "near", "hook", "up").alias("component"),
                               F.col("component").alias("was")), "labels")
        labels = step.select("id", "component")
        if step.where("component <> was").isEmpty():
            return labels
