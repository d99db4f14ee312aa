"""Near-duplicate vectors by collision counting on one-dimensional projections.

Each vector is scaled to length one and projected onto ``PROJECTIONS`` random lines. Two vectors collide on a line if the
other one lies in the window of half-width ``WINDOW`` around the first. Vectors of cosine 0.9 are at most 0.447 apart, so
their projections differ by a normal value of that deviation: a window of two deviations holds the partner with probability
0.954, and a pair of that cosine reaches ``COLLISIONS`` = 20 collisions of 24 with probability above 0.99, while one of
unrelated vectors collides on every second line only. Pairs that reach the count are verified by the cosine in double
precision.

To meet at all without comparing everything, the sorted lines are cut into cells of ``CELL`` at random offsets, and two
vectors meet in a table if they share the cells of ``LINES`` lines. A pair of cosine 0.9 shares a table with probability 0.18
and at least one of ``TABLES`` = 24 with 0.99; closer pairs nearly always do. Recall of linked pairs at the threshold itself is
thus about 0.98, and tests measure it.

Equal vectors are one entry with a count. Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and are their own component. Vectors of different lengths never meet. Rows of one id with different vectors are vectors
of their own, each with its own links and component. Rows of a null id count as links of others, and
get a null component if nothing else names theirs. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import slices
from tripleframe.llm.components import components
from tripleframe.llm.lists import meet
from tripleframe.session import cut

PROJECTIONS = 24
WINDOW = 0.894
COLLISIONS = 20
CELL = 2.7
LINES = 12
TABLES = 24
#: Steps into which a projection is rounded; a window is widened by one.
STEP = 0.04
SEED = 11


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, finite, and not zero."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(F.coalesce(x, F.lit(0.0))))
    return F.coalesce(finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def _lines(dimensions: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(directions, for every table its lines and offsets) for vectors of a length, the same everywhere."""
    rng = np.random.default_rng([SEED, dimensions])
    directions = rng.normal(size=(dimensions, 4 * PROJECTIONS))
    tables = [(rng.choice(directions.shape[1], LINES, replace=False), rng.uniform(0, CELL, LINES)) for _ in range(TABLES)]
    return directions, tables


def _mixed(cells: np.ndarray, table: int, dimensions: int) -> np.ndarray:
    """A 64-bit name of the cells of a table."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15 ^ (table * 1_000_003 + dimensions), dtype=np.uint64)
    for column in cells.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _postings(vectors: DataFrame) -> DataFrame:
    """A row (list, node, places) for every vector and table; places are the rounded projections, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(1)
            sizes = np.diff(rows.offsets.to_numpy())
            flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(np.append(0, sizes))
            for d in np.unique(sizes):
                of = np.flatnonzero(sizes == d)
                x = flat[starts[of][:, None] + np.arange(d)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                directions, tables = _lines(int(d))
                p = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))) @ directions
                places = np.clip(np.round(p[:, :PROJECTIONS] / STEP) + 128, 0, 255).astype(np.uint8)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PROJECTIONS), len(of), [None, pa.py_buffer(np.ascontiguousarray(places))]).cast(pa.binary())
                for t, (lines, offsets) in enumerate(tables):
                    names = _mixed(np.floor((p[:, lines] + offsets) / CELL), t, int(d))
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(nodes[of]), packed], names=["list", "node", "places"])

    return vectors.select("node", "vector").mapInArrow(run, "list long, node long, places binary")


def _collide(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("places"))
    places = np.frombuffer(column.buffers()[2], np.uint8)[column.offset * PROJECTIONS : (column.offset + len(column)) * PROJECTIONS].reshape(-1, PROJECTIONS)
    reach = int(np.ceil(WINDOW / STEP)) + 1
    x, y = places[a], places[b]
    return (np.maximum(x, y) - np.minimum(x, y) <= reach).sum(axis=1) >= COLLISIONS


def _candidates(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    node = batch.column(batch.schema.get_field_index("node")).to_numpy()
    pairs = np.unique(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])]), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _cosines(pairs: DataFrame) -> DataFrame:
    """Cosine of every pair (a, b, u, v) in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            u, v = (c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[2:4])
            ends = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))
            starts = np.append(0, ends[:-1])
            high = [np.maximum.reduceat(np.abs(w), starts) for w in (u, v)]
            sizes = ends - starts
            u, v = u / np.repeat(high[0], sizes), v / np.repeat(high[1], sizes)
            dot, uu, vv = (np.add.reduceat(w, starts) for w in (u * v, u * u, v * v))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(dot / np.sqrt(uu * vv))], names=["a", "b", "cosine"])

    return pairs.mapInArrow(run, "a long, b long, cosine double")


def links(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Links (a, b, cosine) with a < b between distinct vectors (``node``, ``vector``), each verified."""
    found = meet(_postings(vectors), "node", ["places"], _collide, "a long, b long", _candidates).distinct()
    one = vectors.select(F.col("node").alias("a"), F.col("vector").alias("u"))
    two = vectors.select(F.col("node").alias("b"), F.col("vector").alias("v"))
    paired = found.join(one, "a").join(two, "b").where("size(u) = size(v)").select("a", "b", "u", "v")
    return _cosines(paired).where(F.col("cosine") >= threshold)


def near_duplicates(df: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for every row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    # Adding zero makes -0 and 0 the same bytes.
    plain = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = cut(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(usable(F.col(vector)), plain).alias("_v")).withColumn("_h", F.when(F.col("_v").isNotNull(), F.sha2(F.array_join(F.col("_v").cast("array<string>"), ",").cast("binary"), 256))))
    # Vectors are equal if their texts are. The number of a distinct vector is given by the written table, so rows of one id
    # with different vectors are apart.
    groups = rows.where("_h IS NOT NULL").groupBy("_h").agg(F.min("vec_id").alias("_least"), F.count(F.lit(1)).alias("_copies"), F.any_value("_v").alias("vector"))
    groups = cut(groups.withColumn("node", F.monotonically_increasing_id()))
    found = cut(links(groups.select("node", "vector"), threshold))
    both = found.select("a", "b").unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = groups.select(F.col("node").alias("b"), F.col("_copies").alias("_n"))
    linked = both.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("_n").alias("_links"))
    parts = components(found.select("a", "b"))
    named = parts.join(groups.select("node", "_least"), "node").groupBy("component").agg(F.min("_least").alias("component_id"))
    known = groups.select("_h", "node", "_least", "_copies").join(linked, "node", "left").join(parts, "node", "left").join(named, "component", "left")
    told = known.select(
        F.col("_h").alias("_g"),
        (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"),
        F.coalesce("component_id", "_least").alias("_c"),
    )
    out = rows.drop("_v").join(told, F.col("_h") == F.col("_g"), "left")
    component = F.when(F.col("_g").isNull(), F.col("vec_id")).otherwise(F.col("_c"))
    return out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
