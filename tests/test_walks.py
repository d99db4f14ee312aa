"""Paths and linked lists: compared with brute force, cycles and malformed lists included."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripleframe.model import ClassDef, Graph, Prop, Schema
from tripleframe.operators import paths as p
from tripleframe.operators import rdflist
from tripleframe.session import cut

SCHEMA = Schema([ClassDef("N", (Prop("a", "N", "set"), Prop("b", "N", "set")))])


def graph(spark, a, b=()):
    nodes = sorted({n for e in [*a, *b] for n in e})
    data = [(n, [t for s, t in a if s == n], [t for s, t in b if s == n]) for n in nodes]
    return Graph({"N": cut(spark.createDataFrame(data, "id string, a array<string>, b array<string>"))}, SCHEMA)


def closure(edges):
    found = set(edges)
    while True:
        more = {(x, w) for x, y in found for z, w in edges if y == z} - found
        if not more:
            return found
        found |= more


@pytest.fixture(scope="module")
def random_graph(spark):
    random.seed(8)
    nodes = [f"n{i}" for i in range(9)]
    a = sorted({(random.choice(nodes), random.choice(nodes)) for _ in range(11)} | {("n0", "n0")})
    b = sorted({(random.choice(nodes), random.choice(nodes)) for _ in range(5)})
    return graph(spark, a, b), a, b


def test_repetition_over_cycles(random_graph):
    g, a, b = random_graph
    reach = closure(a)
    nodes = {n for e in a + b for n in e}
    assert rows(p.path(g, "v:s", p.plus("a"), "v:o")) == sorted(reach, key=repr)
    assert rows(p.path(g, "v:s", p.star("a"), "v:o")) == sorted(reach | {(n, n) for n in nodes}, key=repr)
    assert rows(p.path(g, "n0", p.star("a"), "v:o")) == sorted({(o,) for s, o in reach if s == "n0"} | {("n0",)})
    assert rows(p.path(g, "v:s", p.plus("a"), "n0")) == sorted({(s,) for s, o in reach if o == "n0"})
    both = closure(a + b)
    assert rows(p.path(g, "v:s", p.plus(p.any_()), "v:o")) == sorted(both, key=repr)
    back = closure([(o, s) for s, o in a])
    assert rows(p.path(g, "v:s", p.plus(p.inv("a")), "v:o")) == sorted(back, key=repr)
    assert rows(p.path(g, "v:n", p.plus("a"), "v:n")) == sorted({(s,) for s, o in reach if s == o})


def test_sequence_alternative_and_bounds(random_graph):
    g, a, b = random_graph
    ab = {(x, w) for x, y in a for z, w in b if y == z}
    assert rows(p.path(g, "v:s", p.seq("a", "b"), "v:o")) == sorted(ab, key=repr)
    assert rows(p.path(g, "v:s", p.inv(p.seq("a", "b")), "v:o")) == sorted({(o, s) for s, o in ab}, key=repr)
    assert rows(p.path(g, "v:s", p.alt("a", "b"), "v:o")) == sorted({*a, *b}, key=repr)
    two = {(x, w) for x, y in a for z, w in a if y == z}
    three = {(x, w) for x, y in two for z, w in a if y == z}
    assert rows(p.path(g, "v:s", p.times("a", 2, 3), "v:o")) == sorted(two | three, key=repr)
    nodes = {n for e in a + b for n in e}
    assert rows(p.path(g, "v:s", p.times("a", 0, 1), "v:o")) == sorted({(n, n) for n in nodes} | set(a), key=repr)
    seeds = g.tables["N"].where("id in ('n1', 'n2')").select("id")
    want = {(s, o) for s, o in closure(a) if s in ("n1", "n2")}
    assert rows(p.path(g, "v:s", p.plus("a"), "v:o", seeds=seeds)) == sorted(want, key=repr)


def test_many_rounds_merge(spark):
    chain = [(f"c{i:02}", f"c{i + 1:02}") for i in range(14)]
    g = graph(spark, chain)
    assert rows(p.path(g, "c00", p.plus("a"), "v:o")) == [(f"c{i:02}",) for i in range(1, 15)]
    assert p.path(g, "c00", p.plus("a"), "v:o", max_hops=3).count() == 3


def test_routes_use_no_edge_twice(spark):
    a = [("x", "y"), ("y", "x"), ("y", "z")]
    g = graph(spark, a)
    got = p.path(g, "x", p.plus("a"), "v:o", path="v:r", max_hops=5).select("o", F.transform("r", lambda e: e["o"]).alias("r"))
    assert rows(got) == sorted([("y", ["y"]), ("x", ["y", "x"]), ("z", ["y", "z"])], key=repr)
    back = p.path(g, "v:s", p.seq("a", "a"), "z", path="v:r").select("s", F.transform("r", lambda e: e["s"]).alias("r"))
    assert rows(back) == [("x", ["x", "y"])]
    with pytest.raises(ValueError):
        p.path(g, "x", p.plus("a"), "v:o", path="v:r")


def cells(spark, lists):
    data = []
    for head, values in lists.items():
        ids = [head, *[f"{head}.{i}" for i in range(1, len(values))], "rdf:nil"]
        data += [(ids[i], v, ids[i + 1]) for i, v in enumerate(values)]
    return cut(spark.createDataFrame(data, "cell string, first string, rest string"))


LISTS = {"one": ["x"], "two": ["p", "q"], "long": [f"v{i}" for i in range(11)]}


def contents(df):
    found: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["head"], r["pos"])):
        found.setdefault(r["head"], []).append(r["value"])
    return found


def test_positions(spark):
    df = cells(spark, LISTS)
    found = cut(rdflist.list_positions(df))
    assert contents(found) == LISTS
    for r in found.collect():
        assert r["cell"] == (r["head"] if r["pos"] == 0 else f"{r['head']}.{r['pos']}")
    whole = {r["head"]: r["items"] for r in rdflist.list_chunks(found).collect()}
    assert whole == LISTS
    assert max(len(r["items"]) for r in rdflist.list_chunks(found, size=8).collect()) == 8
    assert rows(rdflist.length(found)) == sorted((h, len(v)) for h, v in LISTS.items())
    assert rows(rdflist.last(found, df)) == sorted((h, v[-1]) for h, v in LISTS.items())
    assert rows(rdflist.peek(df)) == sorted((h, v[0]) for h, v in LISTS.items())
    assert rows(rdflist.nth1(found, 2).select("head", "value")) == [("long", "v1"), ("two", "q")]
    assert rdflist.slice_values(found, 3, 3).where(F.size("items") == 0).count() == 3
    for bad in (lambda: rdflist.nth0(found, -1), lambda: rdflist.slice_(found, -1, 2), lambda: rdflist.nth1(found, 0)):
        with pytest.raises(ValueError):
            bad()


def test_malformed_lists_end_and_are_reported(spark):
    loop = spark.createDataFrame([("a", "1", "b"), ("b", "2", "a"), ("h", "3", "t"), ("t", "4", "rdf:nil")], "cell string, first string, rest string")
    assert contents(rdflist.list_positions(loop)) == {"h": ["3", "4"]}
    fork = spark.createDataFrame([("a", "1", "c"), ("b", "2", "c"), ("c", "3", "rdf:nil"), ("d", "4", "c"), ("d", "4", "rdf:nil")], loop.schema)
    assert rows(rdflist.malformed_cells(fork)) == [("c", "several cells lead here"), ("d", "several rests")]


def edited(df, changes):
    return contents(rdflist.list_positions(cut(rdflist.apply_cell_changes(df, changes))))


def test_edits(spark):
    df = cells(spark, LISTS)
    found = cut(rdflist.list_positions(df))
    heads = found.where("pos = 0").select("head")
    valued = heads.withColumn("value", F.lit("new"))
    assert edited(df, rdflist.push(df, valued)) == {h: ["new", *v] for h, v in LISTS.items()}
    assert edited(df, rdflist.append(found, df, valued)) == {h: [*v, "new"] for h, v in LISTS.items()}
    for at in (0, 2):
        rows_at = valued.withColumn("position", F.lit(at).cast("bigint"))
        want = {h: [*v[:at], "new", *v[at:]] if len(v) >= at else v for h, v in LISTS.items()}
        assert edited(df, rdflist.insert(found, df, rows_at)) == want
        gone = heads.withColumn("position", F.lit(at).cast("bigint"))
        kept = {h: v[:at] + v[at + 1 :] if len(v) > max(at, 1) else v for h, v in LISTS.items()}
        assert edited(df, rdflist.drop(found, df, gone)) == kept
    assert edited(df, rdflist.pop(df, heads)) == {h: v[1:] if len(v) > 1 else v for h, v in LISTS.items()}
    assert rows(rdflist.popped(df, heads)) == [("long", "v0"), ("two", "p")]
    swaps = heads.select("head", F.lit(0).cast("bigint").alias("pos_a"), F.lit(1).cast("bigint").alias("pos_b"))
    assert edited(df, rdflist.swap(found, swaps)) == {h: [v[1], v[0], *v[2:]] if len(v) > 1 else v for h, v in LISTS.items()}
    same = swaps.withColumn("pos_b", F.lit(0).cast("bigint"))
    assert rdflist.swap(found, same).count() == 0
    assert edited(df, rdflist.clear(found, df, heads.where("head = 'long'"))) == {h: v for h, v in LISTS.items() if h != "long"}
    assert rows(rdflist.empty(spark.range(1).select(), "l")) == [("rdf:nil",)]


def test_star_holds_nodes_without_edges(spark):
    facts = [("instance", "n0", "a", "n1", "node", None), ("instance", "n2", "name", "x", "data", "xsd:string"), ("instance", "n3", "rdf:type", "Thing", "node", None)]
    g = Graph({}, Schema(), spark.createDataFrame(facts, "graph string, s string, p string, o string, o_kind string, o_type string"))
    assert rows(p.path(g, "v:s", p.star("a"), "v:o")) == [("n0", "n0"), ("n0", "n1"), ("n1", "n1"), ("n2", "n2"), ("n3", "n3")]


def test_an_unknown_edge_gives_no_rows(spark):
    things = spark.createDataFrame([("Thing/1", "x"), ("Thing/2", "y")], "id string, label string")
    g = Graph({"Thing": things}, Schema())
    assert rows(p.path(g, "v:s", "nowhere", "v:o")) == []
    assert rows(p.path(g, "v:s", p.plus("nowhere"), "v:o")) == []
    assert rows(p.path(g, "v:s", p.star("nowhere"), "v:o")) == [("Thing/1", "Thing/1"), ("Thing/2", "Thing/2")]
