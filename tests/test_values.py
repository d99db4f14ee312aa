"""Known results of list, range, text, date, interval and id functions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripleframe.functions import dates, ids, lists, math, text
from tripleframe.operators import combine as c


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def arr(*xs, kind="int"):
    return F.array(*[F.lit(x) for x in xs]).cast(f"array<{kind}>")


def test_sets(spark):
    assert one(spark, lists.set_difference(arr(1, 2, 3, 4), arr(2, 4))) == [1, 3]
    assert one(spark, lists.set_difference(arr(1), arr(1, 2))) == []
    assert one(spark, lists.set_difference(arr(), arr(1))) == []
    assert one(spark, lists.set_intersection(arr(1, 2, 3), arr(2, 3, 4))) == [2, 3]
    assert one(spark, lists.set_intersection(arr(1), arr(2))) == []
    assert one(spark, lists.set_union(arr(1, 2), arr(2, 3))) == [1, 2, 3]
    assert one(spark, lists.set_union(arr(1, 1, 2), arr(2, 2))) == [1, 2]
    assert one(spark, lists.list_to_set(arr(3, 1, 2, 1))) == [1, 2, 3]
    big = one(spark, lists.set_difference(F.sequence(F.lit(0), F.lit(999)), F.sequence(F.lit(500), F.lit(1499))))
    assert big == list(range(500))


def test_set_member_keeps_matching_solutions(spark):
    df = spark.range(1).select(arr(1, 2, 3).alias("s"))
    assert c.set_member(df, 2, "v:s").count() == 1
    assert c.set_member(df, 5, "v:s").count() == 0


def test_member_keeps_multiplicity(spark):
    df = spark.range(1).select(arr(1, 2, 2).alias("s"))
    assert [r.x for r in c.member(df, "v:x", "v:s").collect()] == [1, 2, 2]
    assert c.member(df, 2, "v:s").count() == 2


def test_ranges(spark):
    assert one(spark, lists.range_min(arr(7, 2, 9, 1, 5))) == 1
    assert one(spark, lists.range_max(arr(7, 2, 9, 1, 5))) == 9
    days = F.array(*[F.lit(d).cast("date") for d in ("2024-06-15", "2024-01-01", "2024-03-01")])
    assert one(spark, lists.range_min(days)) == dt.date(2024, 1, 1)
    assert one(spark, lists.range_max(days)) == dt.date(2024, 6, 15)
    df = spark.range(1).select(lists.range_min(arr()).alias("m"))
    assert c.drop_unbound(df, "v:m").count() == 0
    assert one(spark, lists.sum_(arr(), "bigint")) == 0


def test_slice_is_a_python_slice(spark):
    items = ["a", "b", "c", "d"]
    starts, ends = (-6, -4, -2, 0, 1, 3, 5), (None, -5, -1, 0, 2, 4, 9)
    x = arr(*items, kind="string")
    cases = [(s, e) for s in starts for e in ends]
    got = spark.range(1).select([lists.slice_(x, s, e).alias(str(i)) for i, (s, e) in enumerate(cases)]).first()
    assert [got[i] for i in range(len(cases))] == [items[s:e] for s, e in cases]


def test_text(spark):
    assert one(spark, text.substr(F.lit("Socrates"), 3, 0)) == "Soc"
    assert one(spark, text.substr_after(F.lit("Socrates"), 3, 0)) == 5
    assert one(spark, text.substr(F.lit("So"), 3, 0)) is None
    assert one(spark, text.trim(F.lit("\t a b\n"))) == "a b"
    assert one(spark, text.pad(F.lit("ab"), "x", 4)) == "abxx"
    assert one(spark, text.split(F.lit("a.b."), ".")) == ["a", "b", ""]
    assert one(spark, text.similarity(F.lit(""), F.lit(""))) == 1.0
    assert one(spark, text.hamming(F.lit("abc"), F.lit("abdz"))) == 2
    df = spark.range(1).select(F.lit("x").alias("n"))
    assert df.select(text.concat("<v:n>, v:n").alias("v")).first()["v"] == "<x>, x"


def test_substrings_are_all_of_them(spark):
    df = spark.range(1).select(F.lit("abc").alias("t"))
    got = rows(text.substrings(df, "t", "sub", "b", "l", "a").select("sub", "b", "l", "a"))
    word = "abc"
    want = [(word[b : b + n], b, n, 3 - b - n) for b in range(4) for n in range(4 - b)]
    assert got == sorted(want, key=repr)
    places = text.substring_positions(spark.range(1).select(F.lit("aaa").alias("t")), "t", "aa", "b", "a")
    assert rows(places.select("b", "a")) == [(0, 1), (1, 0)]


def test_arithmetic_folds_from_the_left(spark):
    assert one(spark, math.minus(F.lit(10), F.lit(3), F.lit(2))) == 5
    assert one(spark, math.plus(F.lit(1), F.lit(2), F.lit(3), F.lit(4))) == 10
    assert one(spark, math.divide(F.lit(12.0), F.lit(3.0), F.lit(2.0))) == 2.0
    assert one(spark, math.div(F.lit(-7), F.lit(2))) == -3
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0)], "a double, b double")
    assert math.evaluate(df, math.divide("v:a", "v:b"), "v:r").count() == 1
    whole = spark.createDataFrame([(4, 0)], "a int, b int")
    assert math.evaluate(whole, math.div("v:a", "v:b"), "v:r").count() == 0


def test_sequence_is_half_open(spark):
    df = spark.createDataFrame([(0, 6, 2), (3, 3, 1), (5, 1, 1)], "a bigint, b bigint, s bigint")
    got = rows(math.sequence(df, "v:x", "v:a", "v:b", "v:s").select("a", "x"))
    assert got == [(0, 0), (0, 2), (0, 4)]
    assert math.sequence(df.where("a = 0"), "v:x", "v:a", "v:b", "v:s", count=3).count() == 3
    assert math.sequence(df.where("a = 0"), "v:x", "v:a", "v:b", "v:s", count=4).count() == 0


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [
        ("2024-01-01", "2024-04-01", "P91D"),
        ("2025-01-01", "2025-04-01", "P90D"),
        ("2024-01-01", "2024-01-01", "P0D"),
        ("2024-01-01 08:00:00", "2024-01-01 17:30:00", "PT9H30M"),
        ("2024-01-01 00:00:00", "2024-01-04 00:00:00", "P3D"),
        ("2024-01-02", "2024-01-01", "-P1D"),
    ],
)
def test_duration_between(spark, start, end, want):
    kind = "date" if len(start) == 10 else "timestamp_ntz"
    df = spark.sql(f"select cast('{start}' as {kind}) s, cast('{end}' as {kind}) e")
    assert dates.date_duration(df, "v:s", "v:e", "v:d").first()["d"] == want


@pytest.mark.parametrize(
    ("start", "want"),
    [
        ("2020-01-31", "2020-02-29"),
        ("2021-01-31", "2021-02-28"),
        ("2020-02-29", "2020-03-31"),
        ("2020-04-30", "2020-05-31"),
        ("2020-12-31", "2021-01-31"),
        ("2020-03-15", "2020-04-15"),
    ],
)
def test_month_is_added_to_month_ends(spark, start, want):
    for kind, show in (("date", "yyyy-MM-dd"), ("timestamp_ntz", "yyyy-MM-dd")):
        df = spark.sql(f"select cast('{start}' as {kind}) s, 'P1M' d")
        got = dates.date_duration(df, "v:s", "v:e", "v:d").select(F.date_format("e", show).alias("e")).first()["e"]
        assert got == want


@pytest.mark.parametrize(
    ("end", "want"),
    [("2020-03-31", "2020-02-29"), ("2021-03-31", "2021-02-28"), ("2021-01-31", "2020-12-31"), ("2020-02-29", "2020-01-31")],
)
def test_month_is_taken_from_month_ends(spark, end, want):
    df = spark.sql(f"select date'{end}' e, 'P1M' d")
    assert str(dates.date_duration(df, "v:s", "v:e", "v:d").first()["s"]) == want


def test_bound_duration_is_checked(spark):
    df = spark.sql("select date'2024-01-01' s, date'2024-04-01' e, d from values ('P91D'), ('P90D'), ('P3M') as t(d)")
    assert rows(dates.date_duration(df, "v:s", "v:e", "v:d").select("d")) == [("P3M",), ("P91D",)]


def test_durations_survive_parsing(spark):
    random.seed(1)
    pairs = [(random.randrange(40), random.randrange(10**12)) for _ in range(50)] + [(0, 0), (5, 0), (0, 1)]
    df = spark.createDataFrame(pairs, "m bigint, u bigint")
    parsed = df.select("m", "u", dates.parse_duration(dates.format_duration("v:m", "v:u")).alias("d"))
    assert all((r.d.months, r.d.micros) == (r.m, r.u) for r in parsed.collect())
    bad = spark.createDataFrame([("P",), ("PT",), ("1D",), ("P1",), ("",)], "t string")
    assert all(r.d is None for r in bad.select(dates.parse_duration("v:t").alias("d")).collect())


def test_a_time_of_day_is_not_added_to_a_date(spark):
    df = spark.sql("select date'2024-01-01' s, 'PT5H' d")
    assert dates.date_duration(df, "v:s", "v:e", "v:d").count() == 0


def test_intervals(spark):
    moments = spark.sql("select timestamp_ntz'2025-01-01 09:00:00' s, timestamp_ntz'2025-01-01 17:30:00' e")
    assert dates.interval(moments, "v:s", "v:e", "v:iv").first()["iv"] == "2025-01-01T09:00:00Z/2025-01-01T17:30:00Z"
    mixed = spark.sql("select date'2025-01-01' s, timestamp_ntz'2025-04-01 12:00:00' e")
    assert dates.interval(mixed, "v:s", "v:e", "v:iv").first()["iv"] == "2025-01-01/2025-04-01T12:00:00Z"
    iv = spark.sql("select '2025-01-01T09:00:00Z/2025-04-01T17:30:00Z' iv")
    parts = dates.interval(iv, "v:s", "v:e", "v:iv").select(dates.endpoint_type("v:s").alias("a"), dates.endpoint_type("v:e").alias("b"))
    assert tuple(parts.first()) == ("xsd:dateTime", "xsd:dateTime")


def test_three_views_of_an_interval_agree(spark):
    iv = spark.sql("select '2025-01-01/2025-04-01' iv")
    df = dates.interval(iv, "v:s1", "v:e1", "v:iv")
    df = dates.interval_start_duration(df, "v:s2", "v:d2", "v:iv")
    df = dates.interval_duration_end(df, "v:d3", "v:e3", "v:iv")
    r = df.first()
    assert (r.s1, r.e1, r.d2) == (r.s2, r.e3, r.d3) == ("2025-01-01", "2025-04-01", "P90D")
    short = spark.sql("select '2025-01-01T09:00:00Z/2025-01-01T17:30:00Z' iv")
    assert dates.interval_start_duration(short, "v:s", "v:d", "v:iv").first()["d"] == "PT8H30M"
    built = spark.sql("select date'2025-01-01' s, 'P365D' d")
    assert dates.interval_start_duration(built, "v:s", "v:d", "v:iv").first()["iv"] == "2025-01-01/2026-01-01"
    back = spark.sql("select date'2025-04-01' e, 'P90D' d")
    assert dates.interval_duration_end(back, "v:d", "v:e", "v:iv").first()["iv"] == "2025-01-01/2025-04-01"


def test_exactly_one_relation_holds(spark):
    points = range(5)
    spans = [(a, b) for a in points for b in points if a < b]
    df = spark.createDataFrame([(*x, *y) for x in spans for y in spans], "a int, b int, c int, d int")
    got = df.select("*", dates.interval_relation("v:a", "v:b", "v:c", "v:d").alias("r")).collect()
    inverse = dict(zip(dates.ALLEN_RELATIONS[:6], dates.ALLEN_RELATIONS[7:])) | {"equals": "equals"}
    inverse |= {v: k for k, v in inverse.items()}
    by_pair = {(r.a, r.b, r.c, r.d): r.r for r in got}
    assert set(by_pair.values()) == set(dates.ALLEN_RELATIONS)
    assert all(by_pair[(c_, d, a, b)] == inverse[r] for (a, b, c_, d), r in by_pair.items())
    want = {
        ("2024-01-01/2024-04-01", "2024-04-01/2024-07-01"): "meets",
        ("2024-01-01/2024-02-01", "2024-04-01/2024-07-01"): "before",
        ("2024-04-01/2024-07-01", "2024-01-01/2025-01-01"): "during",
        ("2024-01-01/2025-01-01", "2024-04-01/2024-07-01"): "contains",
        ("2024-01-01T08:00:00Z/2024-01-01T12:00:00Z", "2024-01-01T12:00:00Z/2024-01-01T17:00:00Z"): "meets",
    }
    typed = spark.createDataFrame(list(want), "x string, y string")
    for r in typed.select("x", "y", dates.interval_relation_typed("v:x", "v:y").alias("r")).collect():
        assert r.r == want[(r.x, r.y)]


def test_calendar(spark):
    assert str(one(spark, dates.month_end_date(F.lit("2024-02")))) == "2024-02-29"
    week = spark.sql("select date'2024-12-30' d").select(dates.iso_year("v:d").alias("y"), dates.iso_week("v:d").alias("w")).first()
    assert tuple(week) == (2025, 1)
    both = spark.sql("select date'2024-02-29' n, date'2024-02-28' d")
    assert dates.day_after(both, "v:d", "v:n").count() == 1
    assert dates.day_before(both, "v:d", "v:n").count() == 0


def test_ids(spark):
    assert one(spark, ids.idgen("https://base.url", [F.lit("page"), F.lit("1")])) == "https://base.url_page_1"
    assert one(spark, ids.unique("https://base.url", [F.lit("page"), F.lit("1")])) == "https://base.urlacd150a6885f609532931d89844070b1"
    from urllib.parse import quote

    odd = "a b/c~d*e+f%g_h.i-j'k(l)é!"
    assert one(spark, ids.quote(F.lit(odd))) == quote(odd)
    made = [r.v for r in spark.range(200).select(ids.random_id("P/").alias("v")).collect()]
    assert len(set(made)) == 200 and all(len(m) == 2 + ids.RANDOM_LENGTH for m in made)
    fixed = ids.assign_ids(spark.createDataFrame([("x",)], "n string"), "P", "Random")
    assert rows(fixed) == rows(fixed)
