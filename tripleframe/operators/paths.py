"""Path queries: pairs of nodes connected by a regular expression over edges.

Patterns are built from functions. Evaluation moves a frontier of (src, at) pairs one join per edge; a bound
subject seeds the frontier, a bound object seeds the inverse pattern. Unbounded repetition is a semi-naive
loop: each round only extends the pairs found in the round before, and every round is written out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.model import RDF_TYPE, Graph, local_table, variable
from tripleframe.operators.match import _property_rows
from tripleframe.session import cut, cut_counted

#: Rounds after which the tables of the rounds are merged into one.
MERGE_ROUNDS = 8


@dataclass(frozen=True)
class Pattern:
    """A path pattern: an edge, a sequence, an alternative, or a repetition."""

    kind: str
    parts: tuple[Any, ...] = ()
    low: int = 1
    high: int | None = 1
    backward: bool = False


def pred(name: str) -> Pattern:
    """One edge of this name."""
    return Pattern("edge", (name,))


def any_() -> Pattern:
    """One edge of any name."""
    return Pattern("edge", (None,))


def _pattern(p: Pattern | str) -> Pattern:
    return pred(p) if isinstance(p, str) else p


def inv(p: Pattern | str) -> Pattern:
    """The pattern walked backwards."""
    p = _pattern(p)
    if p.kind == "edge":
        return Pattern("edge", p.parts, backward=not p.backward)
    parts = tuple(inv(x) for x in p.parts)
    return Pattern(p.kind, parts[::-1] if p.kind == "seq" else parts, p.low, p.high)


def seq(*ps: Pattern | str) -> Pattern:
    """One pattern after the other."""
    return Pattern("seq", tuple(map(_pattern, ps)))


def alt(*ps: Pattern | str) -> Pattern:
    """Any one of the patterns."""
    return Pattern("alt", tuple(map(_pattern, ps)))


def plus(p: Pattern | str) -> Pattern:
    """One or more repetitions."""
    return Pattern("repeat", (_pattern(p),), 1, None)


def star(p: Pattern | str) -> Pattern:
    """Zero or more repetitions."""
    return Pattern("repeat", (_pattern(p),), 0, None)


def times(p: Pattern | str, low: int, high: int) -> Pattern:
    """Between ``low`` and ``high`` repetitions."""
    return Pattern("repeat", (_pattern(p),), low, high)


def edges(graph: Graph, name: str | None = None) -> DataFrame:
    """(s, p, o) edges between nodes: reference properties of class tables and node facts."""
    parts = []
    if name is not None:
        rows = _property_rows(graph, name)
        if rows is not None:
            parts.append(rows.select("s", F.lit(name).alias("p"), F.col("o").cast("string").alias("o")))
        facts = None if graph.facts is None else graph.facts.where(F.col("p") == name)
    else:
        for cls, df in graph.tables.items():
            for prop in graph.schema.properties(cls).values() if cls in graph.schema else ():
                if not prop.is_data and prop.name in df.columns:
                    held = _property_rows(Graph({cls: df}, graph.schema), prop.name)
                    parts.append(held.select("s", F.lit(prop.name).alias("p"), F.col("o").cast("string").alias("o")))
        facts = None if graph.facts is None else graph.facts.where(F.col("p") != RDF_TYPE)
    if facts is not None:
        parts.append(facts.where(F.col("o_kind") == "node").select("s", "p", "o"))
    if not parts:
        held = [*graph.tables.values(), *([] if graph.facts is None else [graph.facts])]
        if not held:
            raise ValueError("the graph holds no tables and no facts")
        # Nothing has such an edge.
        return held[0].sparkSession.createDataFrame([], "s string, p string, o string")
    return reduce(lambda a, b: a.unionByName(b), parts)


def nodes(graph: Graph) -> DataFrame:
    """``src``: each document, each subject of facts, and each node that an edge leads to, once."""
    parts = [df.select(F.col("id").cast("string").alias("src")) for df in graph.tables.values()]
    if graph.facts is not None:
        parts.append(graph.facts.select(F.col("s").alias("src")))
    return reduce(lambda a, b: a.unionByName(b), [*parts, edges(graph).select(F.col("o").alias("src"))]).distinct()


class _Walk:
    """Evaluation of a pattern over the edges of one graph."""

    def __init__(self, graph: Graph, routes: bool, max_hops: int | None):
        self.graph, self.routes, self.max_hops = graph, routes, max_hops
        self.held: dict[str | None, DataFrame] = {}

    def hold(self, p: Pattern, repeated: bool = False) -> None:
        """Write the edges of unbounded repetitions once: every round reads them."""
        repeated = repeated or (p.kind == "repeat" and p.high is None)
        if p.kind == "edge":
            if repeated and p.parts[0] not in self.held:
                self.held[p.parts[0]] = cut(edges(self.graph, p.parts[0]))
            return
        for part in p.parts:
            self.hold(part, repeated)

    def edges(self, name: str | None) -> DataFrame:
        return self.held[name] if name in self.held else edges(self.graph, name)

    def nodes(self) -> DataFrame:
        return self.start(nodes(self.graph))

    def start(self, seeds: DataFrame) -> DataFrame:
        out = seeds.select("src", F.col("src").alias("at"))
        if self.routes:
            out = out.withColumn("route", F.expr("cast(array() as array<struct<s:string,p:string,o:string>>)"))
        return out

    def step(self, frontier: DataFrame | None, p: Pattern) -> DataFrame:
        if p.kind == "edge":
            return self.hop(frontier, self.links(p))
        if p.kind == "seq":
            return reduce(self.step, p.parts, frontier)
        if p.kind == "alt":
            if all(x.kind == "edge" for x in p.parts):
                # Edges of several names are one set of links: one join instead of one per name.
                links = reduce(lambda a, b: a.unionByName(b), [self.links(x) for x in p.parts])
                return self.unique(self.hop(frontier, links))
            return self.unique(reduce(lambda a, b: a.unionByName(b), [self.step(frontier, x) for x in p.parts]))
        return self.repeat(frontier, p)

    def unique(self, df: DataFrame) -> DataFrame:
        return df.distinct()

    def links(self, p: Pattern) -> DataFrame:
        """(at, to) of an edge pattern, with the edge itself where routes are kept."""
        source, target = ("o", "s") if p.backward else ("s", "o")
        cols = [F.col(source).alias("at"), F.col(target).alias("_to")]
        return self.edges(p.parts[0]).select(*cols, *([F.struct("s", "p", "o").alias("_link")] if self.routes else []))

    def hop(self, frontier: DataFrame | None, links: DataFrame) -> DataFrame:
        """The frontier moved over one link; without a frontier, the links themselves."""
        if frontier is None:
            cols = [F.col("at").alias("src"), F.col("_to").alias("at")]
            return links.select(*cols, *([F.array("_link").alias("route")] if self.routes else []))
        out = frontier.join(links, "at")
        if not self.routes:
            return out.select("src", F.col("_to").alias("at"))
        # A route does not use an edge twice.
        out = out.where(~F.array_contains("route", F.col("_link")))
        return out.select("src", F.col("_to").alias("at"), F.array_append("route", F.col("_link")).alias("route"))

    def repeat(self, frontier: DataFrame | None, p: Pattern) -> DataFrame:
        inner = p.parts[0]
        if p.high is not None:
            return self.bounded(frontier, inner, p.low, p.high)
        if self.routes and self.max_hops is None:
            raise ValueError("routes over an unbounded repetition need max_hops")
        first = self.step(frontier, inner)
        origin = None
        if p.low == 0:
            origin = self.nodes() if frontier is None else frontier
        if self.routes:
            return self.grow_routes(first, inner, origin)
        found = self.closure(first, inner)
        return found if origin is None else self.unique(found.unionByName(origin))

    def bounded(self, frontier: DataFrame | None, inner: Pattern, low: int, high: int) -> DataFrame:
        levels = []
        if low == 0:
            levels.append(self.nodes() if frontier is None else frontier)
        current = frontier
        for n in range(1, high + 1):
            # A written level keeps the next one from computing all levels before it again.
            current = cut(self.unique(self.step(current, inner)))
            if n >= low:
                levels.append(current)
        return self.unique(reduce(lambda a, b: a.unionByName(b), levels))

    def closure(self, first: DataFrame, inner: Pattern) -> DataFrame:
        """All pairs reached by repeating the pattern, given the pairs of its first application."""
        fresh, seen_now = cut_counted(self.unique(first), n=F.count(F.lit(1)))
        rounds = [fresh]
        hops = 1
        while seen_now["n"] and (self.max_hops is None or hops < self.max_hops):
            seen = reduce(lambda a, b: a.unionByName(b), rounds)
            if len(rounds) >= MERGE_ROUNDS:
                seen = cut(seen)
                rounds = [seen]
            found = self.unique(self.step(fresh, inner)).join(seen, ["src", "at"], "left_anti")
            fresh, seen_now = cut_counted(found, n=F.count(F.lit(1)))
            rounds.append(fresh)
            hops += 1
        return reduce(lambda a, b: a.unionByName(b), rounds)

    def grow_routes(self, first: DataFrame, inner: Pattern, origin: DataFrame | None) -> DataFrame:
        fresh, grown = cut_counted(first, n=F.count(F.lit(1)))
        rounds = [fresh] if origin is None else [origin, fresh]
        hops = 1
        while hops < (self.max_hops or 0) and grown["n"]:
            fresh, grown = cut_counted(self.step(fresh, inner), n=F.count(F.lit(1)))
            rounds.append(fresh)
            hops += 1
        return self.unique(reduce(lambda a, b: a.unionByName(b), rounds))


def path(
    graph: Graph,
    subject: Any,
    pattern: Pattern | str,
    obj: Any,
    path: Any = None,
    seeds: DataFrame | None = None,
    max_hops: int | None = None,
) -> DataFrame:
    """Pairs of subject and object connected by the pattern; ``path`` binds the edges of each route.

    ``seeds`` is a one-column frame of subjects to start from when the subject variable is bound elsewhere.
    """
    pattern = _pattern(pattern)
    spark = (next(iter(graph.tables.values())) if graph.tables else graph.facts).sparkSession
    walk = _Walk(graph, path is not None, max_hops)
    backward = seeds is None and variable(subject) is not None and variable(obj) is None
    if seeds is not None:
        frontier = walk.start(seeds.select(F.col(seeds.columns[0]).alias("src")).distinct())
    elif backward:
        frontier = walk.start(local_table(spark, src=[obj]))
        pattern = inv(pattern)
    elif variable(subject) is None:
        frontier = walk.start(local_table(spark, src=[subject]))
    else:
        frontier = None
    walk.hold(pattern)
    pairs = walk.step(frontier, pattern)
    columns = [F.col("src").alias("_s"), F.col("at").alias("_o")]
    if backward:
        columns = [F.col("at").alias("_s"), F.col("src").alias("_o")]
    if path is not None:
        columns.append((F.reverse("route") if backward else F.col("route")).alias("_path"))
    out = pairs.select(*columns)
    out = out if path is not None else out.distinct()
    if variable(obj) is None and not backward:
        out = out.where(F.col("_o") == obj)
    same = variable(subject) is not None and variable(subject) == variable(obj)
    if same:
        out = out.where(F.col("_s") == F.col("_o"))
    keep = []
    for source, arg in (("_s", subject), ("_o", obj), ("_path", path)):
        name = variable(arg) if arg is not None else None
        if name is not None and not (same and source == "_o"):
            keep.append(F.col(source).alias(name))
    return out.select(*keep)


def hops(route: Any) -> Any:
    """Length of a route."""
    from tripleframe.model import column

    return F.size(column(route))


__all__: Sequence[str] = [
    "Pattern", "alt", "any_", "edges", "hops", "inv", "path", "plus", "pred", "seq", "star", "times",
]
