"""Graph pattern scans. Each returns a frame with one column per variable.

A pattern with a constant predicate reads the two columns it needs from the class tables that hold that
property; only an unbound predicate reads the facts as quads.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.model import RDF_TYPE, Graph, Lit, Var, variable
from tripleframe.operators.combine import family as _family
from tripleframe.operators.combine import opt as optional
from tripleframe.operators.spread import nearest, neighbours


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _family_of(value: Any) -> str:
    """Family of a Python constant."""
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float, decimal.Decimal)):
        return "number"
    return "moment" if isinstance(value, (dt.date, dt.datetime)) else "string"


def _property_parts(graph: Graph, predicate: str) -> list[DataFrame]:
    """(s, o) rows of a property, one frame for each class table that holds it, in the table's own type."""
    parts = []
    for cls, df in graph.tables.items():
        if predicate == RDF_TYPE:
            parts.append(df.select(F.col("id").alias("s"), F.lit(cls).alias("o")))
        elif predicate in df.columns and predicate != "id":
            values = F.col(predicate)
            if isinstance(df.schema[predicate].dataType, T.ArrayType):
                parts.append(df.select(F.col("id").alias("s"), F.explode(F.array_distinct(values)).alias("o")))
            else:
                parts.append(df.select(F.col("id").alias("s"), values.alias("o")).where(F.col("o").isNotNull()))
    return parts


def _widened(parts: list[DataFrame]) -> DataFrame:
    """The parts as one: in the widest type of their family, as text if they are of several families."""
    kinds = {part.schema["o"].dataType for part in parts}
    if len({_family(k) for k in kinds}) > 1:
        parts = [part.withColumn("o", F.col("o").cast("string")) for part in parts]
    elif len(kinds) > 1 and _family(next(iter(kinds))) == "moment":
        parts = [part.withColumn("o", F.col("o").cast("timestamp_ntz")) for part in parts]
    return _union(parts)


def _property_rows(graph: Graph, predicate: str) -> DataFrame | None:
    """(s, o) rows of a property straight from the class tables, or None if no table holds it."""
    parts = _property_parts(graph, predicate)
    return _widened(parts) if parts else None


def _spark(graph: Graph) -> SparkSession:
    held = graph.facts if graph.facts is not None else next(iter(graph.tables.values()), None)
    if held is None:
        raise ValueError("the graph has neither class tables nor facts")
    return held.sparkSession


def _rows(graph: Graph, predicate: str | None, constant: Any = None) -> DataFrame:
    """(s, p, o) rows for a constant or unbound predicate; a constant object filters each class table in its own type."""
    if predicate is None:
        rows = graph.quads().select("s", "p", "o")
        return rows if constant is None else rows.where(F.col("o") == F.lit(constant).cast("string"))
    parts = _property_parts(graph, predicate)
    if constant is not None:
        parts = [part.where(F.col("o") == F.lit(constant)) for part in parts if _family(part.schema["o"].dataType) == _family_of(constant)]
    if graph.facts is not None:
        facts = graph.facts.where(F.col("p") == predicate)
        if constant is not None:
            shadow = {"number": "o_num", "moment": "o_ts"}.get(_family_of(constant), "o")
            facts = facts.where(F.col(shadow) == (F.lit(constant) if shadow != "o" else F.lit(constant).cast("string")))
        parts.append(facts.select("s", "o"))
    if not parts:
        # A property that nothing holds has no solutions.
        return _spark(graph).createDataFrame([], "s string, p string, o string")
    return _widened(parts).withColumn("p", F.lit(predicate))


def bind(rows: DataFrame, positions: dict[str, Any]) -> DataFrame:
    """Filter on the constant positions, equate repeated variables and keep one column per variable."""
    columns: dict[str, Column] = {}
    for source, arg in positions.items():
        name = variable(arg)
        if name is None:
            value = arg.value if isinstance(arg, Lit) else arg
            rows = rows if value is None else rows.where(F.col(source) == F.lit(value))
        elif name in columns:
            rows = rows.where(F.col(source) == columns[name])
        else:
            columns[name] = F.col(source)
    return rows.select([c.alias(name) for name, c in columns.items()])


def triple(graph: Graph, sub: Any, pred: Any, obj: Any, opt: DataFrame | None = None) -> DataFrame:
    """Match facts; ``opt`` gives the solutions to extend by the pattern where it matches."""
    predicate = None if variable(pred) else pred
    constant = None if variable(obj) is not None else obj.value if isinstance(obj, Lit) else obj
    held = _rows(graph, predicate, constant)
    rows = bind(held, {"s": sub, "p": pred, **({} if constant is not None else {"o": obj})})
    return rows if opt is None else optional(opt, rows)


def quad(graph: Graph, sub: Any, pred: Any, obj: Any, name: Any, opt: DataFrame | None = None) -> DataFrame:
    """Match facts of a named graph; the graph may itself be a variable."""
    if name is None or name == "":
        raise ValueError("a quad needs a graph")
    held = variable(name)
    if held is None:
        return triple(graph.using(graph=name), sub, pred, obj, opt)
    predicate = None if variable(pred) else pred
    facts = graph.quads()
    facts = facts if predicate is None else facts.where(F.col("p") == predicate)
    rows = bind(facts.select("graph", "s", "p", "o"), {"s": sub, "p": pred, "o": obj, "graph": name})
    return rows if opt is None else optional(opt, rows)


def star(
    graph: Graph,
    name: str | None = None,
    subj: Any = Var("Subject"),
    pred: Any = Var("Predicate"),
    obj: Any = Var("Object"),
) -> DataFrame:
    """Every fact, or every fact of one graph."""
    return triple(graph, subj, pred, obj) if name is None else quad(graph, subj, pred, obj, name)


def all_facts(
    graph: Graph, subj: Any = None, pred: Any = None, obj: Any = None, name: str | None = None
) -> DataFrame:
    """Every fact, with constants in the positions given."""
    return star(graph, name, subj or Var("Subject"), pred or Var("Predicate"), obj or Var("Object"))


def added(changes: DataFrame, sub: Any, pred: Any, obj: Any, name: Any = None) -> DataFrame:
    """Facts added by a set of changes."""
    return _changed(changes, "+", sub, pred, obj, name)


def removed(changes: DataFrame, sub: Any, pred: Any, obj: Any, name: Any = None) -> DataFrame:
    """Facts removed by a set of changes."""
    return _changed(changes, "-", sub, pred, obj, name)


def _changed(changes: DataFrame, op: str, sub: Any, pred: Any, obj: Any, name: Any) -> DataFrame:
    rows = changes.where(F.col("op") == op).select("graph", "s", "p", "o").distinct()
    return bind(rows, {"s": sub, "p": pred, "o": obj, "graph": name})


def _value(arg: Any) -> Any:
    return arg.value if isinstance(arg, Lit) else arg


def _typed_parts(graph: Graph, pred: Any, family: str) -> list[DataFrame]:
    """(s, p, o) rows of one family of types, one frame for each source."""
    predicate = None if variable(pred) else pred
    parts = []
    if predicate is not None:
        held = _property_parts(graph, predicate)
        parts = [part.withColumn("p", F.lit(predicate)) for part in held if _family(part.schema["o"].dataType) == family]
        facts = None if graph.facts is None else graph.facts.where(F.col("p") == predicate)
    else:
        facts = graph.quads()
    if facts is not None:
        shadow = {"number": F.col("o_num"), "moment": F.col("o_ts")}.get(family, F.when(F.col("o_num").isNull() & F.col("o_ts").isNull(), F.col("o")))
        parts.append(facts.select("s", "p", shadow.alias("o")).where(F.col("o").isNotNull()))
    return parts


def _typed_rows(graph: Graph, pred: Any, sample: Any, test: Callable[[Column], Column]) -> DataFrame:
    """(s, p, o) rows of the family of ``sample`` that pass the test, which reaches every scan as a filter."""
    parts = [part.where(test(F.col("o"))).select("s", "p", "o") for part in _typed_parts(graph, pred, _family_of(_value(sample)))]
    return _widened(parts) if parts else _spark(graph).createDataFrame([], "s string, p string, o string")


def _between(low: Any, high: Any) -> Callable[[Column], Column]:
    return lambda o: (o >= F.lit(_value(low))) & (o < F.lit(_value(high)))


def triple_slice(graph: Graph, sub: Any, pred: Any, obj: Any, low: Any, high: Any) -> DataFrame:
    """Facts whose typed object lies in ``[low, high)``."""
    return bind(_typed_rows(graph, pred, low, _between(low, high)), {"s": sub, "p": pred, "o": obj})


def triple_slice_rev(graph: Graph, sub: Any, pred: Any, obj: Any, low: Any, high: Any) -> DataFrame:
    """The facts of ``triple_slice`` with the largest object first."""
    rows = _typed_rows(graph, pred, low, _between(low, high))
    return bind(rows.orderBy(F.col("o").desc(), "s"), {"s": sub, "p": pred, "o": obj})


def quad_slice(graph: Graph, sub: Any, pred: Any, obj: Any, low: Any, high: Any, name: str) -> DataFrame:
    return triple_slice(graph.using(graph=name), sub, pred, obj, low, high)


def quad_slice_rev(graph: Graph, sub: Any, pred: Any, obj: Any, low: Any, high: Any, name: str) -> DataFrame:
    return triple_slice_rev(graph.using(graph=name), sub, pred, obj, low, high)


def _adjacent(graph: Graph, sub: Any, pred: Any, obj: Any, other: Any, forward: bool) -> DataFrame:
    bound_obj, bound_other = variable(obj) is None, variable(other) is None
    if bound_obj or bound_other:
        # A bound reference needs no order: the nearest value is a minimum or a maximum.
        reference = _value(obj if bound_obj else other)
        above = forward == bound_obj
        rows = _typed_rows(graph, pred, reference, lambda o: o > F.lit(reference) if above else o < F.lit(reference))
        found = rows.groupBy("s", "p").agg((F.min("o") if above else F.max("o")).alias("found"))
        return bind(found, {"s": sub, "p": pred, "found": other if bound_obj else obj})
    step = {"following": "near"} if forward else {"previous": "near"}
    families = ["number", "moment", "string"]
    if variable(pred) is None and graph.facts is None:
        held = {_family(p.schema["o"].dataType) for p in _property_parts(graph, pred)}
        families = [f for f in [*families, *sorted(held - set(families))] if f in held]
    parts = []
    for family in families:
        # Values are next to each other within their family of types.
        rows = _widened([p.select("s", "p", "o") for p in _typed_parts(graph, pred, family)]).distinct()
        if variable(sub) is None:
            rows = rows.where(F.col("s") == sub)
        parts.append(neighbours(rows, ["s", "p"], "o", **step).where(F.col("near").isNotNull()))
    if not parts:
        empty = _spark(graph).createDataFrame([], "s string, p string, o string, near string")
        return bind(empty, {"s": sub, "p": pred, "o": obj, "near": other})
    if len(parts) > 1:
        parts = [p.withColumns({c: F.col(c).cast("string") for c in ("o", "near")}) for p in parts]
    return bind(_union(parts), {"s": sub, "p": pred, "o": obj, "near": other})


def triple_next(graph: Graph, sub: Any, pred: Any, obj: Any, next_val: Any) -> DataFrame:
    """Per subject and predicate the smallest larger value; either end may be bound, or neither."""
    return _adjacent(graph, sub, pred, obj, next_val, True)


def triple_previous(graph: Graph, sub: Any, pred: Any, obj: Any, prev_val: Any) -> DataFrame:
    """Per subject and predicate the largest smaller value; either end may be bound, or neither."""
    return _adjacent(graph, sub, pred, obj, prev_val, False)


def quad_next(graph: Graph, sub: Any, pred: Any, obj: Any, next_val: Any, name: str) -> DataFrame:
    return triple_next(graph.using(graph=name), sub, pred, obj, next_val)


def quad_previous(graph: Graph, sub: Any, pred: Any, obj: Any, prev_val: Any, name: str) -> DataFrame:
    return triple_previous(graph.using(graph=name), sub, pred, obj, prev_val)


def _near_solutions(solutions: DataFrame, graph: Graph, sub: Any, pred: Any, obj: Any, other: Any, forward: bool) -> DataFrame:
    from_object = variable(obj) in solutions.columns
    ref, found = (variable(obj), other) if from_object else (variable(other), obj)
    if ref not in solutions.columns:
        raise ValueError("the solutions bind neither value")
    keys = {place: variable(arg) for place, arg in (("s", sub), ("p", pred)) if variable(arg) is not None}
    if not set(keys.values()) <= set(solutions.columns):
        raise ValueError("subject and predicate must be constants or variables of the solutions")
    own = solutions.schema[ref].dataType
    parts = _typed_parts(graph, pred, _family(own))
    name = variable(found)
    if not parts:
        # No value is of the reference's family.
        none = solutions.where(F.lit(False))
        return none if name is None or name in solutions.columns else none.withColumn(name, F.col(ref))
    held = _widened([p.select("s", "p", "o") for p in parts])
    if variable(sub) is None:
        held = held.where(F.col("s") == F.lit(_value(sub)))
    moments = _family(own) == "moment" and held.schema["o"].dataType != own
    kind = T.TimestampNTZType() if moments else held.select("o").unionAll(solutions.select(ref)).schema["o"].dataType
    values = held.select(*keys, F.col("o").cast(kind).alias("_at")).where(F.col("_at").isNotNull()).distinct()
    asked = solutions.withColumn("_ref", F.col(ref).cast(kind))
    lookups = asked.select(*[F.col(n).alias(place) for place, n in keys.items()], F.col("_ref").alias("_at")).dropna().distinct()
    near = nearest(lookups, values, list(keys), "_at", forward == from_object, "_near").where(F.col("_near").isNotNull())
    near = near.select(*[F.col(place).alias(f"_k_{place}") for place in keys], F.col("_at").alias("_k_at"), "_near")
    condition = F.col("_ref") == F.col("_k_at")
    for place, n in keys.items():
        condition = condition & (F.col(n) == F.col(f"_k_{place}"))
    out = asked.join(near, condition)
    if name is None:
        out = out.where(F.col("_near") == F.lit(_value(found)))
    elif name in solutions.columns:
        out = out.where(F.col("_near") == F.col(name))
    else:
        return out.select(*solutions.columns, F.col("_near").alias(name))
    return out.select(*solutions.columns)


def next_of(solutions: DataFrame, graph: Graph, sub: Any, pred: Any, obj: Any, next_val: Any) -> DataFrame:
    """Extend solutions that bind ``obj`` by the smallest larger value of their subject and predicate; solutions that bind
    ``next_val`` instead get the largest smaller one.

    Subject and predicate are constants or variables of the solutions. The reference need not be a value of the subject.
    Solutions without such a value, with an unbound reference, or of a type that nothing compares with, are dropped.
    Repeated solutions stay repeated; equal references of a subject are looked up once.
    """
    return _near_solutions(solutions, graph, sub, pred, obj, next_val, True)


def previous_of(solutions: DataFrame, graph: Graph, sub: Any, pred: Any, obj: Any, prev_val: Any) -> DataFrame:
    """Extend solutions that bind ``obj`` by the largest smaller value, those that bind ``prev_val`` by the smallest larger
    one; else as ``next_of``."""
    return _near_solutions(solutions, graph, sub, pred, obj, prev_val, False)


__all__ = [
    "added", "all_facts", "bind", "next_of", "previous_of", "quad", "quad_next", "quad_previous", "quad_slice",
    "quad_slice_rev", "removed", "star", "triple", "triple_next", "triple_previous", "triple_slice",
    "triple_slice_rev",
]
