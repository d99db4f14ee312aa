"""Grouping, collecting and counting.

A list value exists in two forms, and both work for groups of any size: rows (group, position, item), and chunks
(group, chunk number, list) that bound the length of each list. A group of at most ``size`` items is one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import QUAD_KEY, names, variable
from tripleframe.operators.spread import number_rows

Template = str | Sequence[str] | dict[str, str]


def _item(template: Template) -> Column:
    if isinstance(template, dict):
        return F.struct(*[F.col(names([v])[0]).alias(k) for k, v in template.items()])
    if isinstance(template, str) or variable(template):
        return F.col(names([template])[0])
    return F.array(*[F.col(n) for n in names(template)])


def group_rows(
    df: DataFrame,
    group_vars: Sequence[Any],
    template: Template,
    item: str = "item",
    pos: str = "pos",
) -> DataFrame:
    """The groups as rows: group variables, position in the list, item. Lists are sorted by the item."""
    keys = names(group_vars)
    rows = df.select(*keys, _item(template).alias(item))
    return number_rows(rows, keys, [item], pos)


def group_by(
    df: DataFrame, group_vars: Sequence[Any], template: Template, output: Any, size: int = 1_000
) -> DataFrame:
    """The groups as sorted lists of at most ``size`` items, numbered by ``chunk`` from 0."""
    keys, name = names(group_vars), names([output])[0]
    rows = group_rows(df, keys, template, "_item", "_pos")
    rows = rows.withColumn("chunk", F.floor(F.col("_pos") / size))
    lists = rows.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_l"))
    return lists.select(*keys, "chunk", F.transform("_l", lambda x: x["_item"]).alias(name))


def collect(df: DataFrame, template: Template, into: Any, size: int = 1_000) -> DataFrame:
    """All solutions as one list in chunks; no solutions give one row with an empty list."""
    name = names([into])[0]
    lists = group_by(df, [], template, into, size)
    none = lists.groupBy().agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    empty = none.select(F.lit(0).cast("bigint").alias("chunk"), F.array().cast(lists.schema[name].dataType).alias(name))
    return lists.unionByName(empty)


def count(df: DataFrame, countvar: Any) -> DataFrame:
    """The number of solutions; none gives 0."""
    return df.agg(F.count(F.lit(1)).alias(names([countvar])[0]))


def group_count(df: DataFrame, group_vars: Sequence[Any], output: Any) -> DataFrame:
    """Length of each group's list, without building the list."""
    return df.groupBy(*names(group_vars)).agg(F.count(F.lit(1)).alias(names([output])[0]))


def group_sum(df: DataFrame, group_vars: Sequence[Any], value: Any, output: Any) -> DataFrame:
    """Sum of each group's list, without building the list."""
    col = value if isinstance(value, Column) else F.col(names([value])[0])
    return df.groupBy(*names(group_vars)).agg(F.sum(col).alias(names([output])[0]))


def group_range(df: DataFrame, group_vars: Sequence[Any], value: Any, low: Any, high: Any) -> DataFrame:
    """Smallest and largest item of each group's list, without building the list."""
    v = names([value])[0]
    out = df.groupBy(*names(group_vars)).agg(F.min(v).alias(names([low])[0]), F.max(v).alias(names([high])[0]))
    return out.where(F.col(names([low])[0]).isNotNull())


def count_distinct(df: DataFrame, group_vars: Sequence[Any], variables: Sequence[Any], output: Any) -> DataFrame:
    """Number of distinct solutions on some variables per group, duplicates removed before the shuffle by group."""
    keys, values = names(group_vars), names(variables)
    return df.select(*keys, *values).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(names([output])[0]))


def triple_count(quads: DataFrame, output: Any, graph: str | None = None) -> DataFrame:
    """Number of facts per graph, or of one graph."""
    name = names([output])[0]
    if graph is not None:
        return quads.where(F.col("graph") == graph).agg(F.count(F.lit(1)).alias(name))
    return quads.groupBy("graph").agg(F.count(F.lit(1)).alias(name))


def size(quads: DataFrame, output: Any, graph: str | None = None) -> DataFrame:
    """Bytes of the lexical terms per graph, or of one graph."""
    terms = [c for c in QUAD_KEY if c in ("s", "p", "o")]
    total = F.coalesce(F.sum(sum((F.octet_length(t) for t in terms), F.lit(0)).cast("bigint")), F.lit(0))
    name = names([output])[0]
    if graph is not None:
        return quads.where(F.col("graph") == graph).agg(total.alias(name))
    return quads.groupBy("graph").agg(total.alias(name))
