"""Positions and neighbours within groups of any size.

A window would send a whole group to one task. Rows are range-partitioned by (group, order) instead, so a big group is
spread over many tasks; each task numbers its own slice and small per-slice totals supply the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.session import cut

#: Bits of the place of a row in its slice, as numbered by ``monotonically_increasing_id``.
_PLACE_BITS = 33


def _sortable(df: DataFrame, name: str) -> Column:
    """The column, or its text where its type has no order."""
    kind = df.schema[name].dataType
    return F.to_json(F.struct(F.col(name))) if _unordered(kind) else F.col(name)


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    return _unordered(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> list[Column]:
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    return cols + [_sortable(df, c) for c in df.columns if c not in named]


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows cut by ranges of (keys, order), written, with the number of their slice."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return cut(ranged.withColumn("_slice", F.spark_partition_id()))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in its group; the remaining columns break ties.

    The input is written once, then sorted by ranges, so that a row's place in its slice and the sizes of the slices before
    it give its place in the whole; that of the first row of its group is taken off. Identical rows have a number of their
    own in the range bounds, so many copies of one row are spread like any rows.
    """
    by = [F.col(k) for k in keys] + _total_order(df, keys, order)
    written = cut(df.withColumn("_copy", F.monotonically_increasing_id()))
    ranged = written.repartitionByRange(*by, "_copy").sortWithinPartitions(*by)
    placed = cut(ranged.select(*df.columns, F.monotonically_increasing_id().alias("_row")))
    own = F.shiftright("_row", _PLACE_BITS)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row a slice, as many as there are shuffle partitions.
    sizes = placed.groupBy(own.alias("_slice")).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), own == F.col("_slice")).select(*df.columns, place.alias(name))
    if not keys:
        return numbered
    firsts = numbered.groupBy(*keys).agg(F.min(name).alias("_first"))
    return _join_null_safe(numbered, firsts, keys).select(*df.columns, (F.col(name) - F.col("_first")).alias(name))


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def neighbours(
    df: DataFrame, keys: Sequence[str], value: str, previous: str | None = None, following: str | None = None
) -> DataFrame:
    """Add the previous and/or next value within each group; values are distinct in a group."""
    ranged = slices(df, keys, [F.col(value)])
    edges = ranged.groupBy(*keys, "_slice").agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    over_slices = Window.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(
        *keys,
        "_slice",
        F.lag("_high").over(over_slices).alias("_before"),
        F.lead("_low").over(over_slices).alias("_after"),
    )
    w = Window.partitionBy(*keys, "_slice").orderBy(value)
    out = ranged
    if previous:
        out = out.withColumn(previous, F.lag(value).over(w))
    if following:
        out = out.withColumn(following, F.lead(value).over(w))
    out = _join_null_safe(out, edges, [*keys, "_slice"])
    if previous:
        out = out.withColumn(previous, F.coalesce(previous, "_before"))
    if following:
        out = out.withColumn(following, F.coalesce(following, "_after"))
    return out.drop("_slice", "_before", "_after")


def nearest(lookups: DataFrame, values: DataFrame, keys: Sequence[str], at: str, following: bool, name: str) -> DataFrame:
    """Add to each lookup the nearest value of its group that is strictly larger (``following``) or smaller than its own.

    Both frames hold the keys and ``at``, of one type, and no row twice. They are sorted together by (keys, ``at``) and cut
    into slices; the last value seen is carried within a slice by a running window and over its border by one row a group
    and slice, so neither a group's values nor its lookups are gathered. A lookup without such a value keeps null.
    """
    rows = lookups.select(*keys, at, F.lit(0).alias("_held")).unionByName(values.select(*keys, at, F.lit(1).alias("_held")))
    # A lookup comes before the equal value, so what it has seen is beyond it.
    order = [F.col(at).desc() if following else F.col(at).asc(), F.col("_held")]
    ranged = slices(rows, keys, order)
    value = F.when(F.col("_held") == 1, F.col(at))
    edges = ranged.groupBy(*keys, "_slice").agg((F.min(value) if following else F.max(value)).alias("_edge"))
    carried = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*keys, "_slice", F.last("_edge", ignorenulls=True).over(carried).alias("_carried"))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = ranged.withColumn("_seen", F.last(value, ignorenulls=True).over(within)).where("_held = 0")
    out = _join_null_safe(seen, edges, [*keys, "_slice"])
    return out.select(*keys, at, F.coalesce("_seen", "_carried").alias(name))
