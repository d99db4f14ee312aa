"""Versions of documents and facts: diff, patch, apply, squash, rebase, snapshots and history.

A patch is a table of changed leaves (id, path, before, after) with values as text; JSON forms are derived
from it. Everything is keyed by document or fact, so each operator is one shuffle on that key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.operators.combine import page
from tripleframe.operators.spread import number_rows
from tripleframe.operators.update import _null_safe, apply_changes, as_changes, last_ops


def leaf_paths(struct: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """Paths of the scalar and list values of a document type; the id is not one of them."""
    for f in struct.fields:
        here = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType):
            yield from leaf_paths(f.dataType, here)
        elif here != ("id",):
            yield here, f.dataType


def _at(path: Sequence[str], side: str = "") -> Column:
    out = F.col(f"{side}`{path[0]}`")
    for name in path[1:]:
        out = out[name]
    return out


def _text(value: Column, kind: T.DataType) -> Column:
    return F.to_json(value) if isinstance(kind, T.ArrayType) else value.cast("string")


def _value(text: Column, kind: T.DataType) -> Column:
    return F.from_json(text, kind) if isinstance(kind, T.ArrayType) else text.try_cast(kind)


def _comparable(value: Column, path: tuple[str, ...], kind: T.DataType, sets: Sequence[str]) -> Column:
    unordered = isinstance(kind, T.ArrayType) and ".".join(path) in sets
    return F.array_sort(F.array_distinct(value)) if unordered else value


def _aligned(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both versions with the properties of either, nested ones included; a missing property is null."""
    if before.schema == after.schema:
        return before, after
    spark = before.sparkSession
    old = before.unionByName(spark.createDataFrame([], after.schema), allowMissingColumns=True)
    new = after.unionByName(spark.createDataFrame([], before.schema), allowMissingColumns=True)
    return old, new.select(*old.columns)


def _sides(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.alias("b").join(after.alias("a"), F.col("b.id") == F.col("a.id"), "full_outer")


def _changed(path: tuple[str, ...], kind: T.DataType, sets: Sequence[str]) -> Column:
    b = _comparable(_at(path, "b."), path, kind, sets)
    a = _comparable(_at(path, "a."), path, kind, sets)
    return ~b.eqNullSafe(a)


# Diff -----------------------------------------------------------------------------------------------


def diff_object(before: DataFrame, after: DataFrame, sets: Sequence[str] = ()) -> DataFrame:
    """(id, path, before, after) of every leaf that differs between documents with the same id."""
    before, after = _aligned(before, after)
    both = before.alias("b").join(after.alias("a"), F.col("b.id") == F.col("a.id"))
    leaves = []
    for path, kind in leaf_paths(before.schema):
        leaf = F.struct(
            F.lit(".".join(path)).alias("path"),
            _text(_at(path, "b."), kind).alias("before"),
            _text(_at(path, "a."), kind).alias("after"),
        )
        leaves.append(F.when(_changed(path, kind, sets), leaf))
    changed = F.filter(F.array(*leaves), lambda x: x.isNotNull())
    return both.select(F.col("b.id").alias("id"), F.inline(changed))


def _nested(struct: T.StructType, leaf: Callable[[tuple[str, ...], T.DataType], Column], prefix: tuple[str, ...] = ()) -> Column | None:
    """Struct shaped like a document whose leaves are given; null where no leaf is set."""
    fields = []
    for f in struct.fields:
        here = (*prefix, f.name)
        if here == ("id",):
            continue
        if isinstance(f.dataType, T.StructType):
            inner = _nested(f.dataType, leaf, here)
            if inner is not None:
                fields.append((f.name, inner))
        else:
            fields.append((f.name, leaf(here, f.dataType)))
    if not fields:
        return None
    any_set = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for _, c in fields])
    return F.when(any_set, F.struct(*[c.alias(name) for name, c in fields]))


def _swap(before: Column, after: Column) -> Column:
    return F.struct(F.lit("SwapValue").alias("@op"), before.alias("@before"), after.alias("@after"))


def diff_version(before: DataFrame, after: DataFrame, sets: Sequence[str] = ()) -> DataFrame:
    """(id, op, body) of every document that differs: ``@insert`` and ``@delete`` carry the document, ``@patch``
    the nested differences. One full outer join by id."""
    before, after = _aligned(before, after)
    both = _sides(before, after)
    leaves = list(leaf_paths(before.schema))
    patch = _nested(
        before.schema,
        lambda path, kind: F.when(_changed(path, kind, sets), _swap(_at(path, "b."), _at(path, "a."))),
    )
    differs = F.lit(False)
    for path, kind in leaves:
        differs = differs | _changed(path, kind, sets)
    op = (
        F.when(F.col("b.id").isNull(), "@insert")
        .when(F.col("a.id").isNull(), "@delete")
        .when(differs, "@patch")
    )
    whole = {side: F.to_json(F.struct(*[F.col(f"{side}.`{c}`") for c in before.columns])) for side in "ba"}
    body = F.when(op == "@insert", whole["a"]).when(op == "@delete", whole["b"]).otherwise(F.to_json(patch))
    return both.select(F.coalesce("b.id", "a.id").alias("id"), op.alias("op"), body.alias("body")).where(
        F.col("op").isNotNull()
    )


# Patch ----------------------------------------------------------------------------------------------


def patch_json(patch: DataFrame, struct: T.StructType) -> DataFrame:
    """(id, patch): the nested JSON form of a patch table."""
    return _patch_body(patch, struct, lambda entry, kind: _swap(_value(entry["before"], kind), _value(entry["after"], kind)), "patch")


def patch_update(patch: DataFrame, struct: T.StructType) -> DataFrame:
    """(id, update): the values after the patch."""
    return _patch_body(patch, struct, lambda entry, kind: _value(entry["after"], kind), "update")


def patch_before(patch: DataFrame, struct: T.StructType) -> DataFrame:
    """(id, before): the values before the patch."""
    return _patch_body(patch, struct, lambda entry, kind: _value(entry["before"], kind), "before")


def _by_document(patch: DataFrame) -> DataFrame:
    entry = F.struct("path", F.struct("before", "after"))
    return patch.groupBy("id").agg(F.map_from_entries(F.collect_list(entry)).alias("_patch"))


def _patch_body(patch: DataFrame, struct: T.StructType, make: Callable[[Column, T.DataType], Column], name: str) -> DataFrame:
    def leaf(path: tuple[str, ...], kind: T.DataType) -> Column:
        entry = F.element_at("_patch", ".".join(path))
        return F.when(entry.isNotNull(), make(entry, kind))

    return _by_document(patch).select("id", F.coalesce(F.to_json(_nested(struct, leaf)), F.lit("{}")).alias(name))


def read_patch(df: DataFrame, struct: T.StructType, body: str = "patch") -> DataFrame:
    """Patch table from (id, JSON patch) rows."""
    leaves = []
    for path, _ in leaf_paths(struct):
        steps = "".join(f"['{p}']" for p in path)
        op = F.get_json_object(body, f"${steps}['@op']")
        leaf = F.struct(
            F.lit(".".join(path)).alias("path"),
            F.get_json_object(body, f"${steps}['@before']").alias("before"),
            F.get_json_object(body, f"${steps}['@after']").alias("after"),
        )
        leaves.append(F.when(op == "SwapValue", leaf))
    return df.select("id", F.inline(F.filter(F.array(*leaves), lambda x: x.isNotNull())))


def _with_patch(table: DataFrame, patch: DataFrame) -> DataFrame:
    return table.join(_by_document(patch), "id", "left")


def _rebuild(struct: T.StructType, make: Callable[[tuple[str, ...], T.DataType], Column], prefix: tuple[str, ...] = ()) -> list[Column]:
    out = []
    for f in struct.fields:
        here = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType):
            inner = _rebuild(f.dataType, make, here)
            touched = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in inner])
            out.append(F.when(_at(here).isNotNull() | touched, F.struct(*inner)).alias(f.name))
        else:
            out.append(make(here, f.dataType).alias(f.name))
    return out


def _patched(path: tuple[str, ...], kind: T.DataType, ready: Column) -> Column:
    entry = F.element_at("_patch", ".".join(path))
    stored = _at(path)
    return stored if path == ("id",) else F.when(entry.isNotNull() & ready, _value(entry["after"], kind)).otherwise(stored)


def patch(table: DataFrame, changes: DataFrame) -> DataFrame:
    """Documents after a patch; other documents and other properties stay."""
    rows = _with_patch(table, changes)
    return rows.select(*_rebuild(table.schema, lambda path, kind: _patched(path, kind, F.lit(True))))


def _conflicts(struct: T.StructType, match_final_state: bool) -> Column:
    kind = "array<struct<path:string,stored:string,before:string,after:string>>"
    found = []
    for path, held in leaf_paths(struct):
        entry = F.element_at("_patch", ".".join(path))
        stored = _text(_at(path), held)
        wrong = entry.isNotNull() & ~stored.eqNullSafe(entry["before"])
        if match_final_state:
            wrong = wrong & ~stored.eqNullSafe(entry["after"])
        row = F.struct(
            F.lit(".".join(path)).alias("path"), stored.alias("stored"),
            entry["before"].alias("before"), entry["after"].alias("after"),
        )
        found.append(F.when(wrong, row))
    return F.filter(F.array(*found).cast(kind), lambda x: x.isNotNull())


def patch_conflicts(table: DataFrame, changes: DataFrame, match_final_state: bool = True) -> DataFrame:
    """(id, path, stored, before, after) of leaves whose stored value is neither the one before nor the one after."""
    rows = _by_document(changes).join(table, "id")
    return rows.select("id", F.inline(_conflicts(table.schema, match_final_state)))


def patch_resource(table: DataFrame, changes: DataFrame, match_final_state: bool = True) -> DataFrame:
    """Stored documents after a patch; a document with any conflict is left as it is (see ``patch_conflicts``)."""
    rows = _with_patch(table, changes).withColumn("_ok", F.size(_conflicts(table.schema, match_final_state)) == 0)
    ready = F.coalesce(F.col("_ok"), F.lit(False))
    return rows.select(*_rebuild(table.schema, lambda path, kind: _patched(path, kind, ready)))


def patched_ids(table: DataFrame, changes: DataFrame, match_final_state: bool = True) -> DataFrame:
    """Ids of the documents a patch changes without conflict."""
    rows = _by_document(changes).join(table, "id")
    return rows.where(F.size(_conflicts(table.schema, match_final_state)) == 0).select("id")


# Apply ----------------------------------------------------------------------------------------------


def _three_way(before: DataFrame, after: DataFrame, target: DataFrame) -> DataFrame:
    """Versions of each document side by side; structs, one row per id of any version."""
    packed = []
    for df, name in ((before, "b"), (after, "a"), (target, "t")):
        packed.append(df.select("id", F.lit(name).alias("_v"), F.struct(*before.columns).alias("_doc")))
    rows = packed[0].unionByName(packed[1]).unionByName(packed[2])
    return rows.groupBy("id").agg(*[F.max(F.when(F.col("_v") == v, F.struct("_doc")))["_doc"].alias(v) for v in "bat"])


def _merge(rows: DataFrame, struct: T.StructType) -> tuple[Column, Column]:
    """(merged document, conflict) of a three-way compare, leaf by leaf."""

    def leaf(path: tuple[str, ...], kind: T.DataType) -> Column:
        b, a, t = (_at((v, *path)) for v in "bat")
        return F.when(~b.eqNullSafe(a), a).otherwise(t)

    def build(s: T.StructType, prefix: tuple[str, ...] = ()) -> list[Column]:
        out = []
        for f in s.fields:
            here = (*prefix, f.name)
            if isinstance(f.dataType, T.StructType):
                inner = build(f.dataType, here)
                held = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in inner])
                out.append(F.when(held, F.struct(*inner)).alias(f.name))
            else:
                out.append((_at(("t", "id")) if here == ("id",) else leaf(here, f.dataType)).alias(f.name))
        return out

    clash = F.lit(False)
    same = F.lit(True)
    for path, _ in leaf_paths(struct):
        b, a, t = (_at((v, *path)) for v in "bat")
        clash = clash | (~b.eqNullSafe(a) & ~t.eqNullSafe(b) & ~t.eqNullSafe(a))
        same = same & t.eqNullSafe(b)
    both_new = F.lit(False)
    for path, _ in leaf_paths(struct):
        both_new = both_new | ~_at(("a", *path)).eqNullSafe(_at(("t", *path)))
    b, a, t = F.col("b"), F.col("a"), F.col("t")
    merged = (
        F.when(b.isNull() & a.isNull(), t)
        .when(b.isNull(), F.when(t.isNull(), a).otherwise(t))
        .when(a.isNull(), F.when(t.isNotNull() & ~same, t))
        .when(t.isNull(), F.lit(None))
        .otherwise(F.when(clash, t).otherwise(F.struct(*build(struct))))
    )
    changed = F.lit(False)
    for path, _ in leaf_paths(struct):
        changed = changed | ~_at(("b", *path)).eqNullSafe(_at(("a", *path)))
    conflict = (
        F.when(b.isNull() & a.isNotNull() & t.isNotNull() & both_new, "insert")
        .when(b.isNotNull() & a.isNull() & t.isNotNull() & ~same, "delete")
        .when(b.isNotNull() & a.isNotNull() & t.isNull() & changed, "missing")
        .when(b.isNotNull() & a.isNotNull() & t.isNotNull() & clash, "patch")
    )
    return merged, conflict


def apply_difference(before: DataFrame, after: DataFrame, target: DataFrame) -> DataFrame:
    """Target after taking over the difference before → after; documents in conflict stay as they are."""
    rows = _three_way(before, after, target)
    merged, _ = _merge(rows, target.schema)
    return rows.select(merged.alias("_d")).where(F.col("_d").isNotNull()).select("_d.*").select(*target.columns)


def apply_conflicts(before: DataFrame, after: DataFrame, target: DataFrame) -> DataFrame:
    """(id, conflict) of the documents the difference cannot be applied to."""
    rows = _three_way(before, after, target)
    _, conflict = _merge(rows, target.schema)
    return rows.select("id", conflict.alias("conflict")).where(F.col("conflict").isNotNull())


# Change logs ----------------------------------------------------------------------------------------


def squash(changes: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Many commits as one: the last change of each fact.

    With the facts the commits start from, changes without effect on them are left out: a fact that is added and removed
    again, an addition of a known one, a removal of a missing one.
    """
    ends = as_changes(last_ops(changes))
    if base is None:
        return ends
    known = _null_safe(ends.where("op = '-'"), base, "left_semi")
    return known.unionByName(_null_safe(ends.where("op = '+'"), base, "left_anti"))


def rebase(base: DataFrame, branch_changes: DataFrame) -> DataFrame:
    """Facts of another base after replaying a branch's commits on it: the last change of each fact decides."""
    return apply_changes(base, squash(branch_changes), net=True)


def snapshot(base: DataFrame, changes: DataFrame, seq: int) -> DataFrame:
    """Facts as of a commit number."""
    return apply_changes(base, changes.where(F.col("seq") <= seq))


def snapshot_at(base: DataFrame, changes: DataFrame, commits: DataFrame, commit_id: str) -> DataFrame:
    """Facts as of a commit id."""
    # A commit id names one commit: the broadcast side is one row.
    at = commits.where(F.col("commit_id") == commit_id).select(F.col("seq").alias("_at")).limit(1)
    return apply_changes(base, changes.join(F.broadcast(at), F.col("seq") <= F.col("_at")).drop("_at"))


def log(commits: DataFrame, start: int = 0, count: int = -1) -> DataFrame:
    """Commits, newest first; ``count`` -1 returns all after ``start``."""
    if count >= 0:
        return page(commits, start, count, "ts", "seq", order="desc")
    if start == 0:
        return commits.orderBy(F.col("ts").desc(), F.col("seq").desc())
    order = [F.col("ts").desc(), F.col("seq").desc()]
    return number_rows(commits, [], order, "_pos").where(F.col("_pos") >= start).drop("_pos")


def commit_history(commits: DataFrame, max_history: int = 500) -> DataFrame:
    """The newest commits."""
    if max_history < 0:
        raise ValueError("max_history must not be negative")
    return log(commits, 0, max_history)


def document_history(
    doc_changes: DataFrame,
    commits: DataFrame,
    ids: DataFrame | None = None,
    start: int = 0,
    count: int = 10,
) -> DataFrame:
    """(doc_id, commit fields) of the commits that touch each document, newest first, one page per document."""
    touched = doc_changes if ids is None else doc_changes.join(ids.select("doc_id"), "doc_id", "left_semi")
    touched = touched.select("doc_id", "commit_id").distinct()
    rows = touched.join(commits, "commit_id")
    order = [F.col("ts").desc(), F.col("seq").desc()]
    placed = number_rows(rows, ["doc_id"], order, "pos")
    return placed.where((F.col("pos") >= start) & (F.col("pos") < start + count))


def document_times(doc_changes: DataFrame, commits: DataFrame) -> DataFrame:
    """(doc_id, created, updated): first and last time each document was touched."""
    rows = doc_changes.select("doc_id", "commit_id").join(commits.select("commit_id", "ts"), "commit_id")
    return rows.groupBy("doc_id").agg(F.min("ts").alias("created"), F.max("ts").alias("updated"))


__all__: Sequence[Any] = [
    "apply_conflicts", "apply_difference", "commit_history", "diff_object", "diff_version", "document_history",
    "document_times", "leaf_paths", "log", "patch", "patch_before", "patch_conflicts", "patch_json", "patch_resource",
    "patch_update", "patched_ids", "read_patch", "rebase", "snapshot", "snapshot_at", "squash",
]
