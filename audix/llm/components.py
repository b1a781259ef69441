"""Connected components of an edge table by local contraction and alternating large and small stars.

Every task first replaces its edges by stars (its own components, found by repeated minima), so few
rounds remain. A round is grouped minima and joins, written to the shared checkpoint
folder; a hub's neighbours are never gathered into one row. The rounds end when every node
has one centre and no centre has another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.common import join_counted, releasing, staged

#: Edges that a task contracts together.
HELD = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of every node of the edges that is not the least itself."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[x], label[y])
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(nodes))
            return nodes[moved], nodes[label[moved]]
        label = new


@releasing
def _contract(batches):
    held, size = [], 0

    def out():
        x, y = stars(*(np.concatenate(c) for c in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > HELD:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _done(pairs: DataFrame) -> bool:
    """Whether every x has one y and no y is an x."""
    ends = pairs.select(F.col("x").alias("k"), F.lit(1).alias("own")).union(pairs.select("y", F.lit(0)))
    seen = ends.groupBy("k").agg(F.sum("own").alias("own"), F.min("own").alias("least"))
    return seen.where("own > 1 OR (own = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (columns a, b; longs); a component is its least node.

    Least nodes of components are rows as well.
    """
    spark = edges.sparkSession
    pairs = staged(spark, edges.where("a != b").select("a", "b").mapInArrow(_contract, "x bigint, y bigint").distinct(), "edges")
    while not _done(pairs):
        both = pairs.union(pairs.select("y", "x")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = join_counted(both, low, "u").where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = join_counted(large, low, "x")
        ends = small.where("y > m").select(F.col("y").alias("a"), F.col("m").alias("b")).union(low.select("x", "m"))
        pairs = staged(spark, ends.mapInArrow(_contract, "x bigint, y bigint").distinct(), "stars")
    return pairs.union(pairs.select("y", "y")).toDF("node", "component").distinct()
