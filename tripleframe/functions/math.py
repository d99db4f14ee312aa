"""Arithmetic on columns. Operations with several arguments fold from the left; no result is null."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import column, names


def plus(*args: Any) -> Column:
    return reduce(lambda a, b: a + b, map(column, args))


def minus(*args: Any) -> Column:
    return reduce(lambda a, b: a - b, map(column, args))


def times(*args: Any) -> Column:
    return reduce(lambda a, b: a * b, map(column, args))


def divide(*args: Any) -> Column:
    """Division left to right; a zero divisor gives null, which drops the solution in ``evaluate``."""
    return reduce(F.try_divide, map(column, args))


def div(*args: Any) -> Column:
    """Integer division left to right, truncating towards zero."""

    def whole(a: Column, b: Column) -> Column:
        return F.when(b != 0, F.call_function("div", a, F.nullif(b, F.lit(0))))

    return reduce(whole, map(column, args))


def exp(first: Any, second: Any) -> Column:
    """First to the power of second."""
    return F.pow(column(first), column(second))


def floor(value: Any) -> Column:
    return F.floor(column(value))


def evaluate(df: DataFrame, arith: Column, res: Any) -> DataFrame:
    """Bind the value of an arithmetic expression; solutions without a value are dropped."""
    name = names([res])[0]
    return df.withColumn(name, arith).where(F.col(name).isNotNull())


def sequence(
    df: DataFrame, value: str, start: Any, end: Any, step: Any = None, count: str | int | None = None
) -> DataFrame:
    """Generate the values of ``[start, end)``; ``count`` is bound to their number, or checked against it."""
    first, last = column(start), column(end)
    items = F.sequence(first, last) if step is None else F.sequence(first, last, column(step))
    items = F.filter(F.when(first < last, items), lambda x: x < last)
    out = df.withColumn("_items", items)
    if isinstance(count, int):
        out = out.where(F.size("_items") == count)
    elif count is not None:
        out = out.withColumn(names([count])[0], F.size("_items"))
    return out.withColumn(names([value])[0], F.explode("_items")).drop("_items")
