"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, staged


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, comp) of all links of one task."""
    above: dict = {}

    def root(x):
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    kind = None
    for b in batches:
        kind = b.column(0).type
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            above.setdefault(x, x)
            above.setdefault(y, y)
            low, high = sorted((root(x), root(y)))
            above[high] = low
    if above:
        nodes = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)], ["node", "comp"])


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of ``links`` (x, y): comp is the least node that links reach.

    A table of at most BROADCAST_ROWS links, counted first, is resolved by union and find in one task. In a larger one
    each round every node takes the least label around it, then its label's label, so that long chains shrink
    by halves. Every round is a stored table.
    """
    links = staged(links.select("x", "y"), "edges")
    if links.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        kind = links.schema["x"].dataType.simpleString()
        return staged(links.coalesce(1).mapInArrow(united, f"node {kind}, comp {kind}"), "labels")
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    both = staged(both, "links")
    labels = staged(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.min("x")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "comp"), "y").groupBy(F.col("x").alias("node")).agg(F.min("comp").alias("c"))
        step = labels.join(near, "node").select("node", F.least("comp", "c").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        step = step.join(jump, "comp", "left").select("node", F.least("comp", "above").alias("comp"), "was")
        step = staged(step, "labels")
        labels = step.select("node", "comp")
        if step.filter("comp <> was").isEmpty():
            return labels
