"""Joins, unbound values, windows over big groups, range and interval joins: compared with brute force."""

from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripleframe.functions.dates import ALLEN_RELATIONS
from tripleframe.operators import agg
from tripleframe.operators import combine as c
from tripleframe.model import Graph, Schema, date
from tripleframe.operators import match
from tripleframe.operators.spread import neighbours, number_rows


def test_numbering(spark):
    random.seed(3)
    data = [("hot" if random.random() < 0.5 else random.choice("abc"), random.randrange(20)) for _ in range(400)]
    data += [(None, 1), (None, 2), ("hot", 7), ("hot", 7)]
    df = spark.createDataFrame(data, "k string, x int")
    want, at = [], {}
    for k, x in sorted(data, key=lambda d: (d[0] is not None, d[0] or "", d[1])):
        at[k] = at.get(k, -1) + 1
        want.append((k, x, at[k]))
    assert rows(number_rows(df, ["k"], ["x"])) == sorted(want, key=repr)
    assert [r.pos for r in number_rows(df, [], ["k", "x"]).orderBy("pos").collect()] == list(range(len(data)))


def test_neighbours(spark):
    random.seed(4)
    data = sorted({("hot" if random.random() < 0.6 else random.choice("ab"), random.randrange(900)) for _ in range(300)})
    df = spark.createDataFrame(data, "k string, x int")
    held = {}
    for k, x in data:
        held.setdefault(k, []).append(x)
    want = [(k, x, xs[i - 1] if i else None, xs[i + 1] if i + 1 < len(xs) else None) for k, xs in held.items() for i, x in enumerate(xs)]
    assert rows(neighbours(df, ["k"], "x", "before", "after").select("k", "x", "before", "after")) == sorted(want, key=repr)


def test_start_and_page_in_order(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "a int, b int")
    want = sorted((i % 7, i) for i in range(50))
    assert sorted(tuple(r) for r in c.start(df, 12, "v:a", "v:b").collect()) == want[12:]
    assert [tuple(r) for r in c.page(df, 12, 5, "v:a", "v:b").collect()] == want[12:17]


def test_order_by(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 1)], "a int, b int")
    assert [tuple(r) for r in c.order_by(df, "v:b").collect()] == [(2, 1), (1, 2), (1, None)]
    assert [tuple(r) for r in c.order_by(df, "v:b", order="desc").collect()] == [(1, 2), (2, 1), (1, None)]
    assert [tuple(r) for r in c.order_by(df, "v:a", "v:b", order=["desc", "asc"]).collect()][0] == (2, 1)
    with pytest.raises(ValueError):
        c.order_by(df, "v:a", "v:b", order=["asc"])


def test_select_without_variables_keeps_solutions(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert c.select(df).count() == 2 and c.select(df).columns == []
    assert agg.count(c.select(df), "v:n").first()["n"] == 2
    assert rows(c.and_(df, c.true(spark))) == [(1,), (2,)]


def test_distinct_keeps_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 9), (2, "z", 0)], "k int, x string, y int")
    assert rows(c.distinct(df, "v:k")) == [(1, "a", 9), (2, "z", 0)]
    assert rows(c.once(df, "v:k")) == rows(c.distinct(df, "v:k"))


def test_eq_unifies(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert rows(c.eq(df, "v:a", "v:b")) == [(1, 1)]
    assert rows(c.eq(df, "v:b", 2)) == [(1, 2)]
    assert rows(c.eq(df, "v:n", "v:b").select("n")) == [(1,), (2,)]
    assert c.eq(df, "v:l", ["x", "y"]).first()["l"] == ["x", "y"]
    with pytest.raises(ValueError):
        c.eq(df, "v:p", "v:q")


def _compatible(a, b, shared):
    return all(a[k] is None or b[k] is None or a[k] == b[k] for k in shared)


def _merge(a, b, cols):
    return tuple(a[k] if a.get(k) is not None else b.get(k) for k in cols)


def _loose(spark, seed, cols):
    random.seed(seed)
    data = [tuple(random.choice([None, 1, 2, 3]) if k in ("x", "y") else i for k in cols) for i in range(12)]
    df = spark.createDataFrame(data, ", ".join(f"{k} int" for k in cols))
    return c.mark_unbound(df, ["x", "y"]), [dict(zip(cols, d)) for d in data]


def test_unbound_values_agree_with_any_value(spark):
    left, ls = _loose(spark, 1, ["x", "y", "l"])
    right, rs = _loose(spark, 2, ["x", "y", "r"])
    cols = ["x", "y", "l", "r"]
    both = [(a, b) for a, b in product(ls, rs) if _compatible(a, b, ["x", "y"])]
    assert rows(c.and_(left, right, pairs=True).select(*cols)) == sorted((_merge(a, b, cols) for a, b in both), key=repr)
    alone = [a for a in ls if not any(_compatible(a, b, ["x", "y"]) for b in rs)]
    with_any = [a for a in ls if a not in alone]
    assert rows(c.not_(left, right)) == sorted((tuple(a.values()) for a in alone), key=repr)
    assert rows(c.exists(left, right)) == sorted((tuple(a.values()) for a in with_any), key=repr)
    want = [_merge(a, b, cols) for a, b in both] + [(a["x"], a["y"], a["l"], None) for a in alone]
    assert rows(c.opt(left, right, pairs=True).select(*cols)) == sorted(want, key=repr)


def test_marks_follow_the_operators(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1, 5)], "x int, y int")
    extended = c.opt(a, b)
    assert c.maybe_unbound(extended) == {"y"}
    assert c.maybe_unbound(c.or_(a, b)) == {"y"}
    assert rows(extended) == [(1, 5), (2, None)]
    joined = c.and_(extended, spark.createDataFrame([(7, 0)], "y int, z int"), pairs=True)
    assert rows(joined.select("x", "y", "z")) == [(2, 7, 0)]
    assert c.maybe_unbound(joined) == set()


def test_no_shared_variable(spark):
    a, b = spark.range(3).toDF("a"), spark.range(2).toDF("b")
    assert c.and_(a, b, pairs=True).count() == 6
    assert c.not_(a, b).count() == 0 and c.not_(a, b.where("b > 5")).count() == 3
    assert c.exists(a, b).count() == 3 and c.exists(a, b.where("b > 5")).count() == 0
    with pytest.raises(ValueError):
        c.and_(a, b)


def test_semi_join_keeps_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1, 5), (1, 6)], "x int, y int")
    assert rows(c.exists(a, b)) == [(1,), (1,)]


@pytest.mark.parametrize("hot", [100_000, 3])
def test_range_join(spark, monkeypatch, hot):
    monkeypatch.setattr(c, "HOT_ROWS", hot)
    random.seed(5)
    points = [(i, random.randrange(100)) for i in range(80)]
    spans = [(i, s, s + random.randrange(0, 40)) for i, s in enumerate(random.sample(range(100), 30))]
    got = c.range_join(
        spark.createDataFrame(points, "p int, at int"), spark.createDataFrame(spans, "i int, s int, e int"), "at", "s", "e"
    )
    want = [(p, i) for p, at in points for i, s, e in spans if s <= at < e]
    assert rows(got.select("p", "i")) == sorted(want, key=repr)


def test_range_join_of_spans_of_any_length(spark):
    """A span over all data beside short ones, tiny, huge and unbounded ones, and odd points."""
    spans = [(0, -1e18, 1e18), (1, 0.0, 5e-324), (2, 1.0, 1.0000001), (3, 1e300, 1.1e300), (4, 5.0, float("inf")), (5, 7.0, 7.0), (6, None, 3.0), (7, float("-inf"), 0.0)]
    spans += [(10 + i, float(i), i + 0.5) for i in range(50)]
    points = [(i, v) for i, v in enumerate([0.0, 5e-324, 1.0, 1.05e300, -1e300, float("inf"), float("-inf"), None, 7.0, 49.5] + [i / 4 for i in range(200)])]
    got = c.range_join(spark.createDataFrame(points, "p int, at double"), spark.createDataFrame(spans, "i int, s double, e double"), "at", "s", "e")
    want = [(p, i) for p, at in points for i, s, e in spans if None not in (at, s, e) and s <= at < e]
    assert rows(got.select("p", "i")) == sorted(want, key=repr)
    none = c.range_join(spark.createDataFrame(points, "p int, at double"), spark.createDataFrame([], "i int, s double, e double"), "at", "s", "e")
    assert none.count() == 0


def test_join_of_two_masks(spark):
    """Every pair agrees on what both bind; each input is read once."""
    values = [None, 1, 2]
    a = [(0, x, y, 10 * i + j) for i, x in enumerate(values) for j, y in enumerate(values)]
    b = [(0, x, y, 100 + 10 * i + j) for i, x in enumerate(values) for j, y in enumerate(values)] + [(1, 1, 1, 200)]
    left = c.mark_unbound(spark.createDataFrame(a, "k int, x int, y int, l int"), ["x", "y"])
    right = c.mark_unbound(spark.createDataFrame(b, "k int, x int, y long, r int"), ["x", "y"])
    agree = lambda u, v: u is None or v is None or u == v
    first = lambda u, v: v if u is None else u
    want = [(k, first(x, u), first(y, v), m, r) for k, x, y, m in a for j, u, v, r in b if k == j and agree(x, u) and agree(y, v)]
    joined = c.and_(left, right)
    assert rows(joined.select("k", "x", "y", "l", "r")) == sorted(want, key=repr)
    assert c.maybe_unbound(joined) == {"x", "y"}
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_values_of_unlike_types_do_not_meet(spark):
    df = spark.createDataFrame([(1, "1", [1, 2], ["1"])], "n int, t string, ns array<int>, ts array<string>")
    assert c.in_range(df, "v:t", 0, 5).count() == 0 and c.in_range(df, "v:n", 0, 5).count() == 1
    assert c.member(df, "v:t", "v:ns").count() == 0 and c.member(df, "v:n", "v:ns").count() == 1
    assert c.set_member(df, "v:n", "v:ts").count() == 0 and c.set_member(df, "v:t", "v:ts").count() == 1
    numbers, texts = df.select("n"), df.select(F.col("t").alias("n"))
    assert c.and_(numbers, texts).count() == 0
    loose = c.mark_unbound(spark.createDataFrame([(1, "1"), (1, None)], "n int, x string"), ["x"])
    assert rows(c.and_(loose, spark.createDataFrame([(1, 1)], "n int, x int"))) == [(1, "1")]


def test_next_and_previous_of_solutions(spark):
    random.seed(8)
    held = [(f"s{random.randrange(3)}", random.randrange(40)) for _ in range(60)] + [("hot", i % 50) for i in range(300)]
    g = Graph({"A": spark.createDataFrame(held, "id string, v int")})
    asked = [(random.choice(["s0", "s1", "s2", "hot", "none"]), random.choice([None, *range(-2, 52)])) for _ in range(120)]
    df = spark.createDataFrame(asked + asked[:10], "s string, ref long")

    def want(test, best):
        for s, ref in asked + asked[:10]:
            near = [v for t, v in held if t == s and ref is not None and test(v, ref)]
            if near:
                yield (s, ref, best(near))

    larger = sorted(want(lambda v, r: v > r, min), key=repr)
    smaller = sorted(want(lambda v, r: v < r, max), key=repr)
    assert rows(match.next_of(df, g, "v:s", "v", "v:ref", "v:n")) == larger
    assert rows(match.previous_of(df, g, "v:s", "v", "v:n", "v:ref")) == larger
    assert rows(match.previous_of(df, g, "v:s", "v", "v:ref", "v:n")) == smaller
    assert rows(match.next_of(df, g, "v:s", "v", "v:n", "v:ref")) == smaller
    bound = match.next_of(df, g, "v:s", "v", "v:ref", "v:n")
    assert rows(match.next_of(bound, g, "v:s", "v", "v:ref", "v:n")) == larger
    assert match.next_of(bound.withColumn("n", F.lit(-9)), g, "v:s", "v", "v:ref", "v:n").count() == 0
    assert rows(match.next_of(df, g, "hot", "v", "v:ref", 50)) == []
    target = larger[-1][2]
    assert rows(match.next_of(df, g, "v:s", "v", "v:ref", target)) == [(s, r) for s, r, n in larger if n == target]
    assert match.next_of(df.withColumn("ref", F.lit("x")), g, "v:s", "v", "v:ref", "v:n").count() == 0
    with pytest.raises(ValueError):
        match.next_of(df, g, "v:other", "v", "v:ref", "v:n")


def test_numbers_of_rows_without_an_order_and_of_copies(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    got = number_rows(df, ["k"], [])
    assert sorted((r.k, r.pos) for r in got.collect()) == [(k, i) for k in (0, 1) for i in range(500)]
    assert c.page(df, 10, 5, "v:k").count() == 5


@pytest.mark.parametrize("relation", ALLEN_RELATIONS)
def test_interval_join(spark, relation):
    random.seed(6)
    xs = [(i, s, s + random.randrange(1, 20)) for i, s in enumerate(random.choices(range(30), k=25))]
    ys = [(i, s, s + random.randrange(1, 20)) for i, s in enumerate(random.choices(range(30), k=25))]
    x = spark.createDataFrame([(*r, 0) for r in xs], "i int, a int, b int, k int")
    y = spark.createDataFrame([(*r, 0) for r in ys], "j int, c int, d int, k int")
    from tripleframe.functions.dates import holds

    want = rows(x.crossJoin(y.drop("k")).where(holds(relation, "v:a", "v:b", "v:c", "v:d")).select("i", "j"))
    keys = ["k"] if relation in ("before", "after") else []
    right = y if keys else y.drop("k")
    got = c.interval_join(x, right, relation, ("a", "b"), ("c", "d"), keys=keys)
    assert rows(got.select("i", "j")) == want
    if relation == "before":
        with pytest.raises(ValueError):
            c.interval_join(x, y.drop("k"), relation, ("a", "b"), ("c", "d"))


def test_collect(spark):
    names = spark.createDataFrame([("Carol",), ("Alice",), ("Bob",)], "n string").withColumn("d", F.concat(F.lit("N/"), "n"))
    assert rows(agg.collect(names, "v:n", "v:l")) == [(0, ["Alice", "Bob", "Carol"])]
    assert rows(agg.collect(names.where("false"), "v:n", "v:l")) == [(0, [])]
    assert rows(agg.collect(names, "v:n", "v:l", size=2)) == [(0, ["Alice", "Bob"]), (1, ["Carol"])]
    assert agg.collect(names, ["v:n", "v:d"], "v:l").first()["l"][0] == ["Alice", "N/Alice"]


def test_list_forms_hold_the_same_items(spark):
    data = [(i % 3, i * 7 % 50) for i in range(60)]
    df = spark.createDataFrame(data, "k int, x int")
    whole = {k: sorted(x for g, x in data if g == k) for k in range(3)}
    joined: dict = {}
    for r in agg.group_by(df, ["v:k"], "v:x", "v:l", size=7).orderBy("k", "chunk").collect():
        assert len(r.l) <= 7
        joined.setdefault(r.k, []).extend(r.l)
    assert joined == whole
    assert {r.k: r.l for r in agg.group_by(df, ["v:k"], "v:x", "v:l").collect()} == whole


def test_unlike_types_are_never_equal(spark):
    df = spark.createDataFrame([(1, "1", 1.0)], "i int, t string, d double")
    assert c.eq(df, "v:i", "v:t").count() == 0 and c.eq(df, "v:i", "v:d").count() == 1
    assert c.less(df, "v:t", 5).count() == 0 and c.gte(df, "v:d", "v:i").count() == 1


def test_patterns_over_mixed_types(spark):
    a = spark.createDataFrame([("A/1", 8), ("A/2", 10)], "id string, v int")
    b = spark.createDataFrame([("B/1", 9), ("A/1", 2**40)], "id string, v bigint")
    g = Graph({"A": a, "B": b}, Schema([]))
    assert rows(match.triple_slice(g, "v:s", "v", "v:o", 8, 10)) == [("A/1", 8), ("B/1", 9)]
    assert rows(match.triple(g, "v:s", "v", 9)) == [("B/1",)]
    assert rows(match.triple_next(g, "v:s", "v", "v:o", "v:n")) == [("A/1", 8, 2**40)]
    assert rows(match.triple_next(g, "v:s", "v", 8, "v:n")) == [("A/1", 2**40), ("A/2", 10), ("B/1", 9)]
    t = spark.createDataFrame([("T/1", "x")], "id string, v string")
    mixed = Graph({"A": a, "T": t}, Schema([]))
    assert rows(match.triple(mixed, "v:s", "v", 8)) == [("A/1",)] and rows(match.triple(mixed, "v:s", "v", "x")) == [("T/1",)]
    assert rows(match.triple(mixed, "v:s", "v", "v:o")) == [("A/1", "8"), ("A/2", "10"), ("T/1", "x")]
    assert match.triple(g, "v:s", "nothing", "v:o").count() == 0
    days = spark.sql("select 'D/1' as id, date'2024-01-05' as day union all select 'D/2', date'2024-03-01'")
    assert rows(match.triple_slice(Graph({"D": days}, Schema([])), "v:s", "day", "v:o", date("2024-01-01"), date("2024-02-01")).select("s")) == [("D/1",)]
