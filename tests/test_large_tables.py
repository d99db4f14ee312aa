"""What keeps the work on large tables in bounds, held against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripleframe.model import QUAD_SCHEMA
from tripleframe.operators import combine as c
from tripleframe.operators import update, validate
from tripleframe.sources import triples

from .conftest import rows


def _facts(spark, n, shift=0):
    made = spark.range(n).select(F.concat(F.lit("s/"), F.col("id").cast("string")).alias("s"), (F.col("id") % 7 + shift).cast("string").alias("o"))
    return made.selectExpr(
        "'instance' graph", "s", "'p' p", "o", "'data' o_kind", "'xsd:integer' o_type", "cast(o as double) o_num", "cast(null as timestamp_ntz) o_ts"
    )


def _first_exchange_is_above_no_aggregate(df):
    """Whether rows are dealt before any of them is aggregated."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Aggregate" in plan and "Aggregate" not in plan[plan.rindex("Exchange"):]


def test_totals_of_spans_are_those_of_their_pairs(spark):
    rnd = random.Random(3)
    points = [(rnd.choice([None, *range(40)]), rnd.choice([None, 5, -7, 1 << 40])) for _ in range(300)] + [(17, 3)] * 200
    spans = [(k, rnd.choice([None, *range(-5, 45)]), rnd.choice([None, *range(-5, 45)])) for k in range(120)] + [(200, 17, 18), (201, 17, 18), (202, -9, 99)]
    p, s = spark.createDataFrame(points, "at long, x long"), spark.createDataFrame(spans, "span long, a long, b long")
    want = c.range_join(p, s, "at", "a", "b").groupBy("span", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"))
    got = c.range_totals(p.repartition(3), s, "at", "a", "b", ["x"])
    assert got.columns == want.columns and rows(got) == rows(want)
    assert c.range_totals(p.where("false"), s, "at", "a", "b", ["x"]).collect() == []
    with pytest.raises(ValueError):
        c.range_totals(p.withColumn("x", F.col("x").cast("double")), s, "at", "a", "b", ["x"])


def test_replaced_facts_are_dealt_before_they_are_made_unique(spark):
    new = _facts(spark, 50).unionByName(_facts(spark, 20))
    out = triples.update_triples(_facts(spark, 0), new)
    assert _first_exchange_is_above_no_aggregate(out)
    assert rows(out) == rows(_facts(spark, 50))


def test_changes_are_dealt_before_they_are_grouped(spark):
    adds = _facts(spark, 50).unionByName(_facts(spark, 20)).selectExpr("0L seq", "'+' op", "*")
    net = update.net_changes(adds)
    assert _first_exchange_is_above_no_aggregate(net)
    assert rows(net) == rows(_facts(spark, 50).selectExpr("0L seq", "'+' op", "*"))


def test_changes_are_derived_once(spark):
    before, after = _facts(spark, 40), _facts(spark, 60, shift=1)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    changes = update.changes_between(before, after.withColumn("s", counted("s")))
    assert rows(update.apply_changes(before, changes, net=True)) == rows(after)
    assert seen.value == 60
    assert rows(update.change_counts(before, changes)) == [(60, 40)]
    assert seen.value == 120
    none = spark.createDataFrame([], f"seq long, op string, {QUAD_SCHEMA}")
    assert rows(update.change_counts(before, none)) == [(0, 0)]


def test_columns_are_profiled_by_one_set_of_tests(spark, monkeypatch):
    calls = []
    readable = validate._readable
    monkeypatch.setattr(validate, "_readable", lambda *a: (calls.append(1), readable(*a))[1])
    df = spark.createDataFrame(
        [("1", "\ttrue", "1995-01-02", "99999999999999999999", "7", None), (" 2", "no", "1995\t", "1", None, None)],
        "whole string, flag string, moment string, long string, some string, none string",
    )
    found = validate.profile(df)
    assert len(calls) == 1
    assert found.ranges == {
        "whole": "xsd:integer", "flag": "xsd:boolean", "moment": "xsd:dateTime", "long": "xsd:decimal", "some": "xsd:integer", "none": "xsd:string",
    }
    assert found.nulls == {"some", "none"} and found.rows == 2


def test_cells_are_derived_once(spark):
    from tripleframe.operators import rdflist

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    cells = spark.createDataFrame([("a", "x", "b"), ("b", "y", "rdf:nil")], "cell string, first string, rest string")
    found = rdflist.list_positions(cells.withColumn("cell", counted("cell")))
    assert rows(found) == [("a", 0, "a", "x"), ("a", 1, "b", "y")]
    assert seen.value == 2
