"""List and set functions on array columns. Sets are sorted and free of duplicates."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripleframe.model import column


def set_union(a: Any, b: Any) -> Column:
    return F.array_sort(F.array_union(column(a), column(b)))


def set_intersection(a: Any, b: Any) -> Column:
    return F.array_sort(F.array_intersect(column(a), column(b)))


def set_difference(a: Any, b: Any) -> Column:
    return F.array_sort(F.array_except(column(a), column(b)))


def list_to_set(items: Any) -> Column:
    return F.array_sort(F.array_distinct(column(items)))


def slice_(items: Any, start: int | Column, end: int | Column | None = None) -> Column:
    """Part of a list: negative indices count from the end, out-of-range ones are clipped."""
    x = column(items)
    size = F.size(x)

    def place(i: int | Column) -> Column:
        i = F.lit(i) if isinstance(i, int) else i
        return F.least(F.when(i < 0, F.greatest(size + i, F.lit(0))).otherwise(i), size)

    first = place(start)
    last = size if end is None else place(end)
    return F.slice(x, first + 1, F.greatest(last - first, F.lit(0)))


def length(items: Any) -> Column:
    return F.size(column(items))


def sum_(items: Any, kind: str = "double") -> Column:
    """Sum of a list; an empty list gives 0."""
    return F.aggregate(column(items), F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind))


def range_min(items: Any) -> Column:
    """Smallest item; null for an empty list, which drops the solution."""
    return F.array_min(column(items))


def range_max(items: Any) -> Column:
    """Largest item; null for an empty list, which drops the solution."""
    return F.array_max(column(items))


def dot(document: Any, field: str, kind: str = "string") -> Column:
    """Value of a field of a struct, a map, or JSON text; null if it is missing."""
    return column(document).getField(field) if not isinstance(document, JsonText) else document.get(field, kind)


class JsonText:
    """JSON text read by field; parsed by the engine, never in Python."""

    def __init__(self, text: Any):
        self.text = column(text)

    def get(self, field: str, kind: str) -> Column:
        return F.try_variant_get(F.try_parse_json(self.text), f"$.{field}", kind)
