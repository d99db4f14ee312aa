"""Connected components of a graph given as edges, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.session import cut, cut_counted


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its part) with the same parts as the given edges; one edge a node at most."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        # The roots of both ends and the ends themselves take the lower label.
        for at in (x, y, before[x], before[y]):
            np.minimum.at(label, at, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def thin(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components: each batch of a task is replaced by its spanning stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = forest(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest node.

    Alternates two steps until no edge changes: every node's larger neighbours are tied to its smallest neighbour, then its
    smaller neighbours are. Minima are aggregated before the shuffle and tied by joins, so a hub's neighbours are never
    gathered. Rounds are written to the shared folder. Number of rounds: about the logarithm of the longest path, squared at
    worst.
    """
    kept = cut(thin(edges.where("a <> b")).distinct())
    known: tuple[int, int] | None = None
    while True:
        both = kept.select("a", "b").unionAll(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = cut(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        below = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = below.groupBy("a").agg(F.min("b").alias("m"))
        tied = below.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        stars = tied.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct()
        kept, seen = cut_counted(stars, n=F.count(F.lit(1)), h=F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
        now = int(seen["n"]), int(seen["h"])
        if now == known:
            break
        known = now
    return kept.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        kept.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
