"""Changes to facts. An update first gathers all additions and removals, then applies them as one set."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import LITERAL_TYPES, NUMERIC, QUAD_COLUMNS, QUAD_KEY, TEMPORAL, Lit, column, variable
from tripleframe.session import cut

CHANGE_COLUMNS = ["seq", "op", *QUAD_COLUMNS]


def shadows(df: DataFrame) -> DataFrame:
    """Add the typed forms of the object, so ranges can be pushed to the scan."""
    number = F.when(F.col("o_type").isin(*sorted(NUMERIC)), F.col("o").try_cast("double"))
    moment = F.when(F.col("o_type").isin(*sorted(TEMPORAL)), F.col("o").try_cast("timestamp_ntz"))
    return df.withColumn("o_num", number).withColumn("o_ts", moment)


def _node(arg: Any) -> Column:
    return F.lit(arg) if isinstance(arg, str) and variable(arg) is None else column(arg)


def _object(df: DataFrame, obj: Any) -> tuple[Column, Column, Column]:
    """Text, kind and datatype of an object: plain text and text variables are nodes, others literals."""
    if isinstance(obj, Lit):
        text = F.lit(obj.value).cast("string") if not isinstance(obj.value, str) else F.lit(obj.value)
        held = variable(obj.value)
        if held:
            text = F.col(held).cast("string")
        return text, F.lit("data"), F.lit(obj.datatype)
    name = variable(obj)
    kind = df.schema[name].dataType.simpleString() if name else "string"
    if kind == "string":
        return _node(obj), F.lit("node"), F.lit(None).cast("string")
    return F.col(name).cast("string"), F.lit("data"), F.lit(LITERAL_TYPES.get(kind, "xsd:decimal"))


def _change(df: DataFrame, op: str, sub: Any, pred: Any, obj: Any, graph: str, seq: int) -> DataFrame:
    text, kind, datatype = _object(df, obj)
    rows = df.select(
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(op).alias("op"),
        F.lit(graph).alias("graph"),
        _node(sub).alias("s"),
        _node(pred).alias("p"),
        text.alias("o"),
        kind.alias("o_kind"),
        datatype.alias("o_type"),
    )
    return shadows(rows).select(*CHANGE_COLUMNS)


def add_quad(df: DataFrame, sub: Any, pred: Any, obj: Any, graph: str, seq: int = 0) -> DataFrame:
    """Changes that add one fact per solution; older values stay."""
    return _change(df, "+", sub, pred, obj, graph, seq)


def add_triple(df: DataFrame, sub: Any, pred: Any, obj: Any, seq: int = 0) -> DataFrame:
    return add_quad(df, sub, pred, obj, "instance", seq)


def delete_quad(df: DataFrame, sub: Any, pred: Any, obj: Any, graph: str, seq: int = 0) -> DataFrame:
    """Changes that remove one fact per solution."""
    return _change(df, "-", sub, pred, obj, graph, seq)


def delete_triple(df: DataFrame, sub: Any, pred: Any, obj: Any, seq: int = 0) -> DataFrame:
    return delete_quad(df, sub, pred, obj, "instance", seq)


def update_quad(
    quads: DataFrame, df: DataFrame, sub: Any, pred: Any, new_object: Any, graph: str, seq: int = 0
) -> DataFrame:
    """Changes that replace every value of the subject and predicate by the new one."""
    adds = add_quad(df, sub, pred, new_object, graph, seq + 1)
    touched = adds.select("graph", "s", "p").distinct()
    old = quads.join(touched, ["graph", "s", "p"], "left_semi")
    gone = old.select(F.lit(seq).cast("bigint").alias("seq"), F.lit("-").alias("op"), *QUAD_COLUMNS)
    return gone.unionByName(adds)


def update_triple(quads: DataFrame, df: DataFrame, sub: Any, pred: Any, new_object: Any, seq: int = 0) -> DataFrame:
    return update_quad(quads, df, sub, pred, new_object, "instance", seq)


def last_ops(changes: DataFrame) -> DataFrame:
    """First and last change of each fact as ``2 * seq + 1`` for additions and ``2 * seq`` for removals.

    Numbers keep the aggregation hash-based; within one step an addition comes after a removal.
    """
    keys = [F.coalesce(F.col(c), F.lit("")).alias(c) if c == "o_type" else F.col(c) for c in QUAD_KEY]
    at = F.col("seq") * 2 + F.when(F.col("op") == "+", 1).otherwise(0)
    # Dealt by fact first: a fact is seldom changed twice, and no task holds the facts it reads before they are dealt.
    rows = changes.select(*keys, at.alias("_at"), "o_num", "o_ts").repartition("s", "o")
    ends = rows.groupBy(*QUAD_KEY).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.max("o_num").alias("o_num"), F.max("o_ts").alias("o_ts")
    )
    return ends.withColumn("o_type", F.nullif("o_type", F.lit("")))


def as_changes(ends: DataFrame) -> DataFrame:
    """Changes of the last operation of each fact."""
    seq = F.floor(F.col("_last") / 2).cast("bigint")
    op = F.when(F.col("_last") % 2 == 1, "+").otherwise("-")
    return ends.select(seq.alias("seq"), op.alias("op"), *QUAD_COLUMNS)


def net_changes(changes: DataFrame) -> DataFrame:
    """The last change of each fact, an addition winning over a removal of the same step."""
    return as_changes(last_ops(changes))


def into(changes: DataFrame, graph: str) -> DataFrame:
    """The same changes directed at another graph."""
    return changes.withColumn("graph", F.lit(graph)).select(*CHANGE_COLUMNS)


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.select([F.col(c).alias(f"_{c}") for c in QUAD_KEY])
    condition = F.lit(True)
    for c in QUAD_KEY:
        test = F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "o_type" else F.col(c) == F.col(f"_{c}")
        condition = condition & test
    return left.join(right, condition, how)


def apply_changes(quads: DataFrame, changes: DataFrame, net: bool = False) -> DataFrame:
    """Facts after a set of changes: facts exist once, adding a known one or removing a missing one is no change.

    ``net`` says that the changes name each fact once, as those of ``changes_between`` and ``squash`` do.
    """
    # Written, as they are read twice; what they are derived from is read once.
    net = cut(changes if net else net_changes(changes))
    kept = _null_safe(quads, net, "left_anti")
    return kept.select(*QUAD_COLUMNS).unionByName(net.where("op = '+'").select(*QUAD_COLUMNS))


def change_counts(quads: DataFrame, changes: DataFrame) -> DataFrame:
    """(inserts, deletes): how many facts the changes really add and remove."""
    net = cut(net_changes(changes).select("op", *QUAD_KEY))
    known = _null_safe(net, quads, "left_semi").groupBy().agg(_number_of("+").alias("_held"), _number_of("-").alias("deletes"))
    # One row each.
    every = net.groupBy().agg(_number_of("+").alias("_asked"))
    return every.join(known, how="cross").select((F.col("_asked") - F.col("_held")).alias("inserts"), "deletes")


def _number_of(op: str) -> Column:
    return F.count(F.when(F.col("op") == op, 1))


def changes_between(before: DataFrame, after: DataFrame, seq: int = 0) -> DataFrame:
    """Changes that lead from one set of facts to another: one aggregation, no self join."""
    sides = before.select(*QUAD_COLUMNS, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(*QUAD_COLUMNS, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    held = sides.repartition("s", "o").groupBy(*QUAD_KEY).agg(
        F.max("_b").alias("_b"), F.max("_a").alias("_a"), F.max("o_num").alias("o_num"), F.max("o_ts").alias("o_ts")
    )
    return held.where(F.col("_a") != F.col("_b")).select(
        F.lit(seq).cast("bigint").alias("seq"), F.when(F.col("_a") == 1, "+").otherwise("-").alias("op"), *QUAD_COLUMNS
    )
