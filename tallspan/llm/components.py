"""Connected components of a distributed edge list, by least labels and pointer jumping.

Up to MOST_EDGES edges are worked over by one task; more of them in rounds of joins, which give the same labels but
write some files for each partition and round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import cut_off

#: Rows that one partition of a small intermediate table holds at least.
ROWS_EACH = 200_000
#: Edges that one task may hold (some 100 MB with ids of 16 bytes).
MOST_EDGES = 500_000


def settled(df: DataFrame) -> DataFrame:
    """df cut off in the checkpoint folder, in no more partitions than its rows call for (and a few)."""
    df = cut_off(df)
    return df.coalesce(df.count() // ROWS_EACH + 8)


def least_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, component of all edges (a, b) of the batches: roots are hung on lesser ones until no edge joins two of them."""
    sides = [[], []]
    for batch in batches:
        for side, name in zip(sides, "ab", strict=True):
            side.append(batch.column(name))
    n = sum(map(len, sides[0]))
    if not n:
        return
    coded = pa.chunked_array(sides[0] + sides[1]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    of = rank[coded.indices.to_numpy()]
    nodes, a, b, label = coded.dictionary.take(pa.array(order)), of[:n], of[n:], np.arange(len(order))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low < high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while (label != (label := label[label])).any():
            pass
    for at in range(0, len(label), 1 << 16):
        yield pa.RecordBatch.from_arrays([nodes[at : at + (1 << 16)], nodes.take(pa.array(label[at : at + (1 << 16)]))], names=["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of edges (a, b).

    Each round a node takes the least label of its neighbours, then its label's label; paths halve. Every round
    is cut off in the checkpoint folder, and only the number of changes comes to the driver.
    """
    edges = edges.select("a", "b").filter("a <> b")
    if edges.count() <= MOST_EDGES:
        return settled(edges.coalesce(1).mapInArrow(least_nodes, StructType([StructField(n, edges.schema["a"].dataType) for n in ("node", "component")])))
    both = settled(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("of")), "b").groupBy(F.col("a").alias("node")).agg(F.min("of").alias("near"))
        step = settled(labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component")))
        if step.filter("was <> component").isEmpty():
            return step.select("node", "component")
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = settled(step.join(jump, "component", "left").select("node", F.least("component", F.coalesce("next", "component")).alias("component")))


def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """groups (node, component) with further links (a, b): only what they connect is worked over."""
    if links.isEmpty():
        return groups
    lifted = links.join(groups.select(F.col("node").alias("a"), F.col("component").alias("of_a")), "a", "left").join(groups.select(F.col("node").alias("b"), F.col("component").alias("of_b")), "b", "left")
    lifted = settled(lifted.select("a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b")))
    over = components(lifted.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    every = groups.unionByName(lifted.select(F.col("a").alias("node"), F.col("of_a").alias("component"))).unionByName(lifted.select(F.col("b").alias("node"), F.col("of_b").alias("component"))).distinct()
    over = over.select(F.col("node").alias("component"), F.col("component").alias("over"))
    return settled(every.join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component")))
