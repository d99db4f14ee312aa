"""Hard negatives by Four-Russians scoring: exact integer inner products from tables of subset sums.

Components become whole numbers. For each group of eight dimensions an anchor has a table of the 256 sums of its components
over all subsets of the group; a candidate row keeps its numbers as bit planes, where the bits of eight dimensions are one
byte. A plane's part of the inner product is a table look-up per group, and the planes are joined by shifting and adding from
the sign plane (which counts negative, in two's complement) downwards.

Anchors and candidates are packed into blocks of bounded size, and every block of anchors meets every block of candidates in
a cell of its own. A first pass keeps the best rows of an anchor's label per cell, a second one the best rows of other labels
within the window of each positive; both end in a ranking over the cells. A block holds its rows by a hash of their number, so
no label, id or vector makes one large.

Rows with a null label, a null or empty vector, a null or non-finite component, or a component of 2^31 or more after scaling
(a long cannot hold its products) take no part. Vectors of unequal lengths are compared as if the shorter ended in zeros. An
anchor is never its own positive, but a repeated row is another row; a repeated anchor gives its rows again. Null ids are no
anchors and come last among ties. Empty tables and anchors without positives or negatives give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripleframe.session import cut

#: Rows of a block of anchors and of a block of candidates, about.
ANCHORS, ROWS = 256, 4096
#: Anchors whose tables are looked up together; their tables of one group stay in a core's cache.
TOGETHER = 64
#: Absolute values that take part after scaling.
LIMIT = 1 << 31

_NO_SCORE = np.iinfo(np.int64).min
_BLOCK = "block int, numbers array<long>, ids array<long>, known array<boolean>, labels array<long>, planes binary, depth int, groups int"


def whole(vector: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down; null where the vector takes no part."""
    doubles = vector.cast("array<double>")
    fits = F.forall(doubles, lambda x: F.coalesce((F.abs(x * scale) < float(LIMIT)) & ~F.isnan(x), F.lit(False)))
    return F.when(fits & (F.size(doubles) > 0), F.transform(doubles, lambda x: F.floor(x * scale)))


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """Planes of rows of whole numbers, the sign plane first: (planes, groups of eight dimensions, rows) as bytes."""
    rows, dimensions = numbers.shape
    padded = np.zeros((rows, -(-dimensions // 8) * 8), np.int64)
    padded[:, :dimensions] = numbers
    # Two's complement needs one bit more than the largest of the numbers, a negative one counted by its complement.
    depth = int(np.max(padded ^ (padded >> 63), initial=0)).bit_length() + 1
    planes = [np.packbits((padded >> k & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(depth - 1, -1, -1)]
    return np.stack(planes) if rows else np.zeros((depth, padded.shape[1] // 8, 0), np.uint8)


def subset_sums(anchors: np.ndarray, groups: int) -> np.ndarray:
    """Sums over all subsets of every eight components: (groups, 256, anchors)."""
    padded = np.zeros((len(anchors), groups * 8), np.int64)
    width = min(groups * 8, anchors.shape[1])
    padded[:, :width] = anchors[:, :width]
    parts = padded.reshape(len(anchors), groups, 8)
    sums = np.zeros((groups, 256, len(anchors)), np.int64)
    for bit in range(8):
        # Subsets with this bit as the highest one are those below, with one component added.
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + parts[:, :, bit].T[:, None, :]
    return sums


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows of the planes: (anchors, rows)."""
    depth, groups, rows = planes.shape
    out = np.empty((len(anchors), rows), np.int64)
    for at in range(0, len(anchors), TOGETHER):
        some = anchors[at : at + TOGETHER]
        sums = subset_sums(some, groups)
        # A plane's sum is below the sum of absolute components, and half the numbers fit 32 bits.
        largest = int(np.abs(some).sum(axis=1).max(initial=0))
        sums = sums.astype(np.int32) if largest << depth < LIMIT else sums
        total = np.zeros((rows, len(some)), sums.dtype)
        for plane in range(depth):
            part = np.take(sums[0], planes[plane, 0], axis=0)
            for group in range(1, groups):
                part += np.take(sums[group], planes[plane, group], axis=0)
            if plane == 0:
                total -= part
            else:
                total += total
                total += part
        out[at : at + TOGETHER] = total.T
    return out


def _packed(rows: DataFrame) -> DataFrame:
    """One row per ``block`` of rows (``block``, ``number``, ``id``, ``label``, ``vector``)."""

    def pack(table: pa.Table) -> pa.Table:
        vectors = table.column("vector").to_pylist()
        width = max(map(len, vectors))
        numbers = np.zeros((len(vectors), width), np.int64)
        for i, v in enumerate(vectors):
            numbers[i, : len(v)] = v
        planes = bit_planes(numbers)
        ids = table.column("id")
        made = {
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "numbers": pa.array([table.column("number").to_pylist()], pa.list_(pa.int64())),
            "ids": pa.array([ids.fill_null(0).to_pylist()], pa.list_(pa.int64())),
            "known": pa.array([ids.is_valid().to_pylist()], pa.list_(pa.bool_())),
            "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.int64())),
            "planes": pa.array([planes.tobytes()], pa.binary()),
            "depth": pa.array([planes.shape[0]], pa.int32()),
            "groups": pa.array([planes.shape[1]], pa.int32()),
        }
        return pa.table(made)

    return rows.groupBy("block").applyInArrow(pack, _BLOCK)


def _unpacked(row: dict) -> np.ndarray:
    """Whole numbers of a block from its planes: (rows, dimensions)."""
    planes = np.frombuffer(row["planes"], np.uint8).reshape(row["depth"], row["groups"], -1)
    numbers = np.zeros((planes.shape[2], row["groups"] * 8), np.int64)
    for k, plane in enumerate(planes):
        bits = np.unpackbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little").astype(np.int64)
        numbers = numbers * 2 + (bits if k else -bits)
    return numbers


def _best(score: np.ndarray, may: np.ndarray, most: int, known: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the first ``most`` rows of every anchor, among those it may take: high scores, then small ids."""
    masked = np.where(may, score, _NO_SCORE)
    if masked.shape[1] > most:
        bound = np.partition(masked, masked.shape[1] - most, axis=1)[:, -most]
        may = may & (masked >= bound[:, None])
    a, r = np.nonzero(may)
    order = np.lexsort((numbers[r], ids[r], ~known[r], -score[a, r], a))
    a, r = a[order], r[order]
    first = np.searchsorted(a, a)
    kept = np.arange(len(a)) - first < most
    return a[kept], r[kept]


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every block of anchors with every block of candidates, a row each, over a grid of cells."""
    anchors, rows = (d.select("block").distinct() for d in (left, right))
    sizes = [d.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0] for d in (anchors, rows)]
    grid = left.sparkSession.range(sizes[0] * sizes[1]).select((F.col("id") % max(1, sizes[0])).cast("int").alias("i"), F.floor(F.col("id") / max(1, sizes[0])).cast("int").alias("j"))
    one = left.select(F.col("block").alias("i"), F.struct(*[c for c in left.columns if c != "block"]).alias("a"))
    two = right.select(F.col("block").alias("j"), F.struct(*[c for c in right.columns if c != "block"]).alias("c"))
    return grid.join(one, "i").join(two, "j").repartition(F.col("i"), F.col("j")).select("a", "c")


def _cells(left: DataFrame, right: DataFrame, choose, schema: str) -> DataFrame:
    """What ``choose`` makes of every cell: it gets the anchors' block, the candidates' block, and the scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                a, c = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                planes = np.frombuffer(c["planes"], np.uint8).reshape(c["depth"], c["groups"], -1)
                for side in (a, c):
                    side.update({n: np.array(side[n], kind) for n, kind in (("numbers", np.int64), ("ids", np.int64), ("known", bool), ("labels", np.int64))})
                yield from choose(a, c, scores(_unpacked(a), planes))

    return _meet(left, right).mapInArrow(run, schema)


def _positives(a: dict, c: dict, score: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    may = (a["labels"][:, None] == c["labels"]) & (a["numbers"][:, None] != c["numbers"])
    x, r = _best(score, may, most, c["known"], c["ids"], c["numbers"])
    made = {"anchor": a["numbers"][x], "number": c["numbers"][r], "score": score[x, r]}
    ids = pa.array(c["ids"][r], mask=~c["known"][r])
    yield pa.RecordBatch.from_arrays([*map(pa.array, made.values()), ids], names=[*made, "id"])


def _negatives(a: dict, c: dict, score: np.ndarray, most: int, window: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The best of each anchor for each of its positives' scores; ``bounds`` has them per anchor, equal ones once."""
    other = a["labels"][:, None] != c["labels"]
    for k in range(max((len(b) for b in a["bounds"]), default=0)):
        which = np.array([i for i, b in enumerate(a["bounds"]) if len(b) > k])
        bound = np.array([a["bounds"][i][k] for i in which], np.int64)[:, None]
        # 50 p <= 100 n <= 95 p, in whole numbers: p / 2 rounded up, 95 p / 100 rounded down.
        low, high = -(-window[0] * bound // 100), window[1] * bound // 100
        some = score[which]
        x, r = _best(some, other[which] & (some >= low) & (some <= high), most, c["known"], c["ids"], c["numbers"])
        made = {"anchor": a["numbers"][which[x]], "bound": bound[x, 0], "number": c["numbers"][r], "score": some[x, r]}
        ids = pa.array(c["ids"][r], mask=~c["known"][r])
        yield pa.RecordBatch.from_arrays([*map(pa.array, made.values()), ids], names=[*made, "id"])


def _ranked(found: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "number")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256) -> DataFrame:
    """Rows ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``anchor`` says of a row whether it is one. A negative's score lies
    between the two hundredths of its positive's score that ``window`` names.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole(F.col("embedding"), scale).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asked"))
    # Numbers are written with the rows, so a task that runs again reads the same ones.
    told = cut(rows.where("label IS NOT NULL AND vector IS NOT NULL").withColumn("number", F.monotonically_increasing_id()))
    sizes = told.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("a")).first()
    block = lambda count, of: F.pmod(F.xxhash64("number"), F.lit(max(1, -(-count // of)))).cast("int")
    candidates = cut(_packed(told.select(block(sizes["n"], ROWS).alias("block"), "number", "id", "label", "vector")))
    asked = cut(_packed(told.where("asked").select(block(sizes["a"], ANCHORS).alias("block"), "number", "id", "label", "vector")))
    near = _cells(asked, candidates, lambda a, c, s: _positives(a, c, s, positives), "anchor long, number long, score long, id long")
    best = cut(_ranked(near, ["anchor"], positives, "place"))
    # Each anchor's block learns the scores that its anchors' negatives are held against.
    bounds = best.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("bound"))
    placed = asked.select("block", F.posexplode("numbers").alias("at", "anchor")).join(bounds, "anchor", "left")
    by_block = placed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("bound", F.array().cast("array<long>")).alias("bound")))).alias("_b"))
    armed = asked.join(by_block.select("block", F.col("_b.bound").alias("bounds")), "block")
    far = _cells(armed, candidates, lambda a, c, s: _negatives(a, c, s, negatives, window), "anchor long, bound long, number long, score long, id long")
    hard = _ranked(far, ["anchor", "bound"], negatives, "rank")
    named = told.where("asked").select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(named, "anchor")
    chosen = hard.select(F.col("anchor").alias("_a"), F.col("bound").alias("_p"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = pairs.join(chosen, (F.col("anchor") == F.col("_a")) & (F.col("positive_score") == F.col("_p")))
    return both.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
