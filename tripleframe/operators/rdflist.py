"""Linked lists: cells with a ``first`` value and a ``rest`` pointer to the next cell or nil.

``list_positions`` numbers the cells of all lists at once by pointer doubling. Cells that have reached their
head leave the join, so the head of a long list never becomes a hot key. The other operators are filters and
aggregates over (head, pos, cell, value); edits take many lists at once and return changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import RDF_NIL
from tripleframe.session import cut, cut_counted

POSITIONS = ["head", "pos", "cell", "value"]


def cells_from_quads(quads: DataFrame) -> DataFrame:
    """(cell, first, rest) from list facts; one aggregation by cell."""
    rows = quads.where(F.col("p").isin("rdf:first", "rdf:rest"))
    return rows.groupBy(F.col("s").alias("cell")).agg(
        F.max(F.when(F.col("p") == "rdf:first", F.col("o"))).alias("first"),
        F.max(F.when(F.col("p") == "rdf:rest", F.col("o"))).alias("rest"),
    )


def malformed_cells(cells: DataFrame) -> DataFrame:
    """Cells that break a list: several rests, or several cells that lead to the same one."""
    rests = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = cells.where(F.col("rest") != RDF_NIL).groupBy("rest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rests.select("cell", F.lit("several rests").alias("problem")).unionByName(
        entries.select(F.col("rest").alias("cell"), F.lit("several cells lead here").alias("problem"))
    )


def malformed_facts(quads: DataFrame) -> DataFrame:
    """Problems that are lost when facts become cells: several rests or several firsts of one cell."""
    rows = quads.where(F.col("p").isin("rdf:first", "rdf:rest")).select("s", "p", "o").distinct()
    several = rows.groupBy(F.col("s").alias("cell"), "p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    problem = F.when(F.col("p") == "rdf:rest", "several rests").otherwise("several firsts")
    return several.select("cell", problem.alias("problem"))


def unplaced_cells(cells: DataFrame, positions: DataFrame) -> DataFrame:
    """Cells without a position: those on a cycle, and those that only a cycle leads to."""
    lost = cells.select("cell").distinct().join(positions.select("cell"), "cell", "left_anti")
    return lost.select("cell", F.lit("on a cycle").alias("problem"))


def list_positions(cells: DataFrame) -> DataFrame:
    """(head, pos, cell, value) of every list; cells on a cycle have no head and give no row.

    Each round doubles the length of the jumps, so a list of n cells takes log2 n rounds. Only ids move in
    the rounds; the pointers of unfinished cells are unique, so no join key is hot.
    """
    # Written with the values, which the last join reads: what the cells are derived from is read once.
    cells = cut(cells.select("cell", "rest", "first"))
    links = cells.select("cell", "rest")
    before = links.where(F.col("rest") != RDF_NIL).select(F.col("rest").alias("cell"), F.col("cell").alias("ptr"))
    followed = before.select("cell").distinct()
    heads = links.select("cell").join(followed, "cell", "left_anti").select(F.col("cell").alias("ptr"))
    near = before.join(followed.select(F.col("cell").alias("ptr"), F.lit(False).alias("_head")), "ptr", "left")
    near = near.select("cell", "ptr", F.lit(1).cast("bigint").alias("dist"), F.coalesce("_head", F.lit(True)).alias("done"))
    unfinished = F.count(F.when(~F.col("done"), 1))
    state, sizes = cut_counted(near, left=unfinished)
    done = [state.where("done")]
    open_ = state.where("not done")
    left, before_round = sizes["left"], None
    while left and left != before_round:
        targets = reduce(lambda a, b: a.unionByName(b), [*done, open_])
        jumps = targets.select(
            F.col("cell").alias("ptr"), F.col("ptr").alias("_next"), F.col("dist").alias("_far"), F.col("done").alias("_done")
        )
        moved = open_.drop("done").join(jumps, "ptr").select(
            "cell", F.col("_next").alias("ptr"), (F.col("dist") + F.col("_far")).alias("dist"), F.col("_done").alias("done")
        )
        moved, sizes = cut_counted(moved, left=unfinished)
        done.append(moved.where("done"))
        open_ = moved.where("not done")
        left, before_round = sizes["left"], left
    placed = reduce(lambda a, b: a.unionByName(b), done).select("cell", F.col("ptr").alias("head"), F.col("dist").alias("pos"))
    first = heads.select(F.col("ptr").alias("cell"), F.col("ptr").alias("head"), F.lit(0).cast("bigint").alias("pos"))
    out = placed.unionByName(first).join(cells.select("cell", F.col("first").alias("value")), "cell")
    return out.select(*POSITIONS)


# Reading --------------------------------------------------------------------------------------------


def list_chunks(positions: DataFrame, size: int = 1_000, output: str = "items") -> DataFrame:
    """Lists in chunks of at most ``size`` values, for lists of any length."""
    rows = positions.withColumn("chunk", F.floor(F.col("pos") / size))
    items = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return rows.groupBy("head", "chunk").agg(F.transform(items, lambda x: x["value"]).alias(output))


def peek(cells: DataFrame) -> DataFrame:
    """(head, value): the first value of each list, read from the head cell alone."""
    inner = cells.where(F.col("rest") != RDF_NIL).select(F.col("rest").alias("cell"))
    return cells.join(inner, "cell", "left_anti").select(F.col("cell").alias("head"), F.col("first").alias("value"))


def last(positions: DataFrame, cells: DataFrame) -> DataFrame:
    """(head, value): the value of the cell that leads to nil."""
    ends = cells.where(F.col("rest") == RDF_NIL).select("cell")
    return positions.join(ends, "cell", "left_semi").select("head", "value")


def nth0(positions: DataFrame, index: int | Column | None = None) -> DataFrame:
    """(head, index, value): the value at a 0-based index; without one every index is generated."""
    if isinstance(index, int) and index < 0:
        raise ValueError("the index must not be negative")
    rows = positions if index is None else positions.where(F.col("pos") == index)
    return rows.select("head", F.col("pos").alias("index"), "value")


def nth1(positions: DataFrame, index: int | Column | None = None) -> DataFrame:
    """(head, index, value): the value at a 1-based index; without one every index is generated."""
    if isinstance(index, int) and index < 1:
        raise ValueError("the index must be positive")
    rows = positions.withColumn("index", F.col("pos") + 1)
    rows = rows if index is None else rows.where(F.col("index") == index)
    return rows.select("head", "index", "value")


def member(positions: DataFrame, value: object = None) -> DataFrame:
    """(head, value): every value of every list, or the lists that hold a value."""
    rows = positions if value is None else positions.where(F.col("value") == value)
    return rows.select("head", "value")


def length(positions: DataFrame) -> DataFrame:
    """(head, length) of each list."""
    return positions.groupBy("head").agg((F.max("pos") + 1).alias("length"))


def slice_(positions: DataFrame, start: int, end: int) -> DataFrame:
    """(head, pos, value) of the positions in ``[start, end)``, renumbered from 0; at most ``end - start`` per list."""
    if start < 0 or end < 0:
        raise ValueError("the bounds must not be negative")
    rows = positions.where((F.col("pos") >= start) & (F.col("pos") < end))
    return rows.select("head", (F.col("pos") - start).alias("pos"), "value")


def slice_values(positions: DataFrame, start: int, end: int, output: str = "items") -> DataFrame:
    """(head, list) for every list, of at most ``end - start`` values; an empty range gives empty lists."""
    heads = positions.where("pos = 0").select("head")
    items = F.array_sort(F.collect_list(F.struct("pos", "value")))
    part = slice_(positions, start, end).groupBy("head").agg(F.transform(items, lambda x: x["value"]).alias(output))
    return heads.join(part, "head", "left").withColumn(
        output, F.coalesce(output, F.array().cast(part.schema[output].dataType))
    )


def is_empty(df: DataFrame, head: str = "head") -> DataFrame:
    """Keep solutions whose list is empty."""
    return df.where(F.col(head) == RDF_NIL)


def empty(df: DataFrame, list_var: str) -> DataFrame:
    """Bind the empty list."""
    return df.withColumn(list_var, F.lit(RDF_NIL))


# Editing --------------------------------------------------------------------------------------------
# Every edit returns (op, s, p, o) rows. New cells get ids from the list and the edit, so a task that runs
# again makes the same ids.


def _facts(rows: DataFrame, *facts: tuple[str, Column, str, Column]) -> DataFrame:
    """Change rows; ops and predicates are constant, subjects and objects are columns."""
    items = F.array(
        *[F.struct(F.lit(op).alias("op"), s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o")) for op, s, p, o in facts]
    )
    return rows.select(F.explode(items).alias("_f")).select("_f.*")


def _new_cell(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"Cell/{kind}_"), F.sha2(F.concat_ws("\u0001", *[p.cast("string") for p in parts]), 256))


def _new_cell_type(new: Column) -> tuple[str, Column, str, Column]:
    return ("+", new, "rdf:type", F.lit("rdf:List"))


def push(cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Add a value at the front of each list of (head, value): the head id stays, its old content moves on."""
    rows = edits.select(F.col("head").alias("cell"), "value").join(cells, "cell")
    new = _new_cell("push", F.col("cell"), F.col("first"), F.col("rest"))
    head = F.col("cell")
    return _facts(
        rows,
        _new_cell_type(new),
        ("+", new, "rdf:first", F.col("first")),
        ("+", new, "rdf:rest", F.col("rest")),
        ("-", head, "rdf:first", F.col("first")),
        ("-", head, "rdf:rest", F.col("rest")),
        ("+", head, "rdf:first", F.col("value")),
        ("+", head, "rdf:rest", new),
    )


def append(positions: DataFrame, cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Add a value at the end of each list of (head, value)."""
    ends = positions.join(cells.where(F.col("rest") == RDF_NIL).select("cell"), "cell", "left_semi")
    rows = ends.select("head", "cell").join(edits.select("head", F.col("value").alias("_new")), "head")
    new = _new_cell("append", F.col("cell"), F.col("_new"))
    return _facts(
        rows,
        _new_cell_type(new),
        ("+", new, "rdf:first", F.col("_new")),
        ("+", new, "rdf:rest", F.lit(RDF_NIL)),
        ("-", F.col("cell"), "rdf:rest", F.lit(RDF_NIL)),
        ("+", F.col("cell"), "rdf:rest", new),
    )


def insert(positions: DataFrame, cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Add a value at a position of each list of (head, position, value); position 0 is a push."""
    front = push(cells, edits.where("position = 0").select("head", "value"))
    later = edits.where("position > 0").select(
        "head", (F.col("position") - 1).alias("pos"), F.col("value").alias("_new")
    )
    rows = positions.select("head", "pos", "cell").join(later, ["head", "pos"]).join(cells.select("cell", "rest"), "cell")
    new = F.concat(F.lit("list_node_"), F.sha2(F.concat_ws("\u0001", "cell", "rest", "_new"), 256))
    here = F.col("cell")
    return front.unionByName(
        _facts(
            rows,
            _new_cell_type(new),
            ("+", new, "rdf:first", F.col("_new")),
            ("+", new, "rdf:rest", F.col("rest")),
            ("-", here, "rdf:rest", F.col("rest")),
            ("+", here, "rdf:rest", new),
        )
    )


def pop(cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Remove the first value of each list of (head); a list of one cell gives no change."""
    second = cells.select(F.col("cell").alias("_cell"), F.col("first").alias("_first"), F.col("rest").alias("_rest"))
    rows = edits.select(F.col("head").alias("cell")).join(cells, "cell").join(second, F.col("rest") == F.col("_cell"))
    head, old = F.col("cell"), F.col("_cell")
    return _facts(
        rows,
        ("-", head, "rdf:first", F.col("first")),
        ("-", head, "rdf:rest", F.col("rest")),
        ("-", old, "rdf:type", F.lit("rdf:List")),
        ("-", old, "rdf:first", F.col("_first")),
        ("-", old, "rdf:rest", F.col("_rest")),
        ("+", head, "rdf:first", F.col("_first")),
        ("+", head, "rdf:rest", F.col("_rest")),
    )


def popped(cells: DataFrame, edits: DataFrame) -> DataFrame:
    """(head, value) removed by ``pop``."""
    second = cells.select(F.col("cell").alias("rest"))
    rows = edits.select(F.col("head").alias("cell")).join(cells, "cell").join(second, "rest", "left_semi")
    return rows.select(F.col("cell").alias("head"), F.col("first").alias("value"))


def drop(positions: DataFrame, cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Remove the value at a position of each list of (head, position); position 0 is a pop."""
    front = pop(cells, edits.where("position = 0").select("head"))
    later = edits.where("position > 0").select("head", (F.col("position") - 1).alias("pos"))
    rows = positions.select("head", "pos", "cell").join(later, ["head", "pos"]).join(cells.select("cell", "rest"), "cell")
    gone = cells.select(F.col("cell").alias("_cell"), F.col("first").alias("_first"), F.col("rest").alias("_rest"))
    rows = rows.join(gone, F.col("rest") == F.col("_cell"))
    here, old = F.col("cell"), F.col("_cell")
    return front.unionByName(
        _facts(
            rows,
            ("-", here, "rdf:rest", old),
            ("-", old, "rdf:type", F.lit("rdf:List")),
            ("-", old, "rdf:first", F.col("_first")),
            ("-", old, "rdf:rest", F.col("_rest")),
            ("+", here, "rdf:rest", F.col("_rest")),
        )
    )


def clear(positions: DataFrame, cells: DataFrame, edits: DataFrame) -> DataFrame:
    """Remove every cell of each list of (head); the new list is nil."""
    rows = positions.join(edits.select("head").distinct(), "head", "left_semi").select("cell").join(cells, "cell")
    here = F.col("cell")
    return _facts(
        rows,
        ("-", here, "rdf:type", F.lit("rdf:List")),
        ("-", here, "rdf:first", F.col("first")),
        ("-", here, "rdf:rest", F.col("rest")),
    )


def swap(positions: DataFrame, edits: DataFrame) -> DataFrame:
    """Exchange the values at two positions of each list of (head, pos_a, pos_b)."""
    a = positions.select("head", F.col("pos").alias("pos_a"), F.col("cell").alias("_ca"), F.col("value").alias("_va"))
    b = positions.select("head", F.col("pos").alias("pos_b"), F.col("cell").alias("_cb"), F.col("value").alias("_vb"))
    rows = edits.where("pos_a <> pos_b").join(a, ["head", "pos_a"]).join(b, ["head", "pos_b"])
    rows = rows.where(~F.col("_va").eqNullSafe(F.col("_vb")))
    return _facts(
        rows,
        ("-", F.col("_ca"), "rdf:first", F.col("_va")),
        ("+", F.col("_ca"), "rdf:first", F.col("_vb")),
        ("-", F.col("_cb"), "rdf:first", F.col("_vb")),
        ("+", F.col("_cb"), "rdf:first", F.col("_va")),
    )


def apply_cell_changes(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """Cells after a set of list changes: one aggregation by cell, additions over removals."""
    now = cells.select(
        F.lit(0).alias("op"), "cell", F.col("first").alias("first"), F.col("rest").alias("rest")
    )
    edits = changes.where(F.col("p").isin("rdf:first", "rdf:rest")).select(
        F.when(F.col("op") == "+", 2).otherwise(1).alias("op"),
        F.col("s").alias("cell"),
        F.when(F.col("p") == "rdf:first", F.col("o")).alias("first"),
        F.when(F.col("p") == "rdf:rest", F.col("o")).alias("rest"),
    )
    rows = now.unionByName(edits)

    def final(name: str) -> Column:
        # The latest kind of row that speaks of the property decides; a removal leaves nothing.
        held = F.col(name).isNotNull()
        best = F.max(F.when(held, F.struct("op", name)))
        return F.when(best["op"] != 1, best[name]).alias(name)

    merged = rows.groupBy("cell").agg(final("first"), final("rest"))
    return merged.where(F.col("first").isNotNull() | F.col("rest").isNotNull())


__all__ = [
    "append", "apply_cell_changes", "cells_from_quads", "clear", "drop", "empty", "insert", "is_empty",
    "last", "length", "list_chunks", "list_positions", "malformed_cells", "malformed_facts", "member", "nth0", "nth1", "peek",
    "pop", "popped", "push", "slice_", "slice_values", "swap", "unplaced_cells",
]
