"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouping and a join, so no node's neighbours meet in one task: the smallest neighbour is found by
an aggregate with partial sums, and joined back. A hub that holds a third of all edges is a skewed join key with one
row on the other side, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition reduced to stars: each node points to the smallest node it is joined with.

    A batch is reduced on its own, so memory is bounded by a batch, and a batch of n edges gives at most 2 n rows.
    """
    for batch in batches:
        nodes, ends = np.unique(np.r_[np.asarray(batch.column(0)), np.asarray(batch.column(1))], return_inverse=True)
        n = batch.num_rows
        a, b = ends[:n], ends[n:]
        root = np.arange(len(nodes))
        while True:  # hook the larger root below the smaller one, then shorten the paths
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
        moved = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["a", "b"])


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns a, b); component is its smallest node.

    Defined cases: rows with a null end and loops join nothing and are left out; repeated edges count once; an
    empty table has no components.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = scratch.keep(edges.mapInArrow(_forest, "a long, b long").distinct(), f"{name}-0")

    def signature(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFFFF))).first()
        return tuple(row)

    step, seen = 0, signature(edges)
    while seen[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # large star: larger neighbours move to the smallest one
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = scratch.keep(large, f"{name}-{step}-large")
        # small star: a node and its smaller neighbours point to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(least.select("a", F.col("low").alias("b"))).distinct()
        following = scratch.keep(small, f"{name}-{step + 1}")
        scratch.drop(f"{name}-{step}")
        scratch.drop(f"{name}-{step}-large")
        step, edges, before, seen = step + 1, following, seen, signature(following)
        if seen == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
